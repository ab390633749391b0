"""Vectors against a fixed centre set (e.g. the canopy centres).

For every vector, in one pass over Arrow batches:
  nearest   the nearest centre (snapped distance, ties -> smallest centre id)
  first     the first centre in id (= creation) order strictly within ``t1``
  n_within  how many centres lie strictly within ``t1``
One output row per vector; pairs are never materialised.  The centre set
is indexed (:class:`quiver.functions.distance.CentreIndex`), so a vector meets only
the centres whose lower bound leaves them a part in the answer.  It
travels in the task closure in blocks of at most ``block_bytes``; with several
blocks each block is one pass and the per-block answers are combined by one
aggregation per vector (min / min / sum), so no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quiver.functions.distance import CentreIndex
from quiver.functions.vectors import arrow_matrix
from quiver.operators.persist import reliable
from quiver.operators.kmeans import snap_np

OUT_SCHEMA = "symbol string, nearest string, nearest_dist double, first string, n_within long, n_computed long"
_OUT_ARROW = pa.schema([("symbol", pa.string()), ("nearest", pa.string()), ("nearest_dist", pa.float64()),
                        ("first", pa.string()), ("n_within", pa.int64()), ("n_computed", pa.int64())])
# A tile of distances: a few MB, so the arrays made from it stay small beside the worker itself.
_TILE_ROWS = 1024
_TILE_CENTRES = 400


def _block_pass(ids: list[str], mat: np.ndarray, t1: float, want_nearest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_arr = np.asarray(ids, dtype=object)
        starts = range(0, mat.shape[0], _TILE_CENTRES)
        indexes: dict[int, CentreIndex] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = arrow_matrix(batch.column("v"))
            m = vectors.shape[0]
            best_d = np.full(m, np.inf)
            best_j = np.zeros(m, dtype=np.int64)  # without any comparable distance the first centre stays
            first_j = np.full(m, -1, dtype=np.int64)
            count = np.zeros(m, dtype=np.int64)
            computed = np.zeros(m, dtype=np.int64)
            for r, a in product(range(0, m, _TILE_ROWS), starts):
                if a not in indexes:
                    indexes[a] = CentreIndex(mat[a:a + _TILE_CENTRES])
                tile = slice(r, r + _TILE_ROWS)
                raw, n = indexes[a].distances(vectors[tile], t1, best_d[tile] if want_nearest else None)
                computed[tile] += n
                within = raw < t1
                count[tile] += within.sum(axis=1)
                has = r + np.flatnonzero(within.any(axis=1) & (first_j[tile] < 0))
                first_j[has] = a + within[has - r].argmax(axis=1)
                if not want_nearest:
                    continue
                d = snap_np(raw)
                j = np.argmin(np.where(np.isnan(d), np.inf, d), axis=1)
                dj = d[np.arange(len(d)), j]
                better = np.flatnonzero(dj < best_d[tile])  # strict: earlier (smaller id) centre wins ties
                best_d[r + better] = dj[better]
                best_j[r + better] = a + j[better]
            yield pa.RecordBatch.from_pydict({
                "symbol": batch.column("symbol"),
                "nearest": id_arr[best_j] if want_nearest else [None] * m,
                "nearest_dist": np.where(np.isinf(best_d), np.nan, best_d) if want_nearest else [None] * m,
                "first": np.where(first_j >= 0, id_arr[np.maximum(first_j, 0)], None),
                "n_within": count,
                "n_computed": computed,
            }, schema=_OUT_ARROW)

    return run


def _centre_blocks(centres: DataFrame, rows: int) -> Iterator[list[tuple[str, list[float]]]]:
    """The centres in id order, ``rows`` at a time; the driver holds one block."""
    part = centres.select("centre", "v")
    while block := [(r["centre"], r["v"]) for r in part.orderBy("centre").limit(rows).collect()]:
        yield block
        if len(block) < rows:
            return
        part = centres.select("centre", "v").where(F.col("centre") > F.lit(block[-1][0]))


def match_centres(vectors: DataFrame, centres: DataFrame, t1: float, block_bytes: int = 32 << 20, nearest: bool = True) -> DataFrame:
    """(symbol, v) x centres (centre string, v) -> OUT_SCHEMA, one row per vector.

    Without ``nearest`` the nearest centre and its distance are null, and only centres that may lie
    within ``t1`` are met.  ``n_computed`` is the number of distances computed for the vector.

    The centres come in blocks of ``block_bytes``, so the set may have any size; the
    result of each block is written before the next one is fetched.
    """
    dim = centres.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return vectors.select("symbol", F.lit(None).cast("string").alias("nearest"),
                              F.lit(None).cast("double").alias("nearest_dist"),
                              F.lit(None).cast("string").alias("first"), F.lit(0).cast("long").alias("n_within"),
                              F.lit(0).cast("long").alias("n_computed"))
    per_block = max(1, block_bytes // (max(dim, 1) * 8 + 64))
    parts, held = [], None
    for blk in _centre_blocks(centres, per_block):
        if held is not None:
            parts.append(reliable(held))
        mat = np.asarray([v for _, v in blk], dtype=np.float64)
        held = vectors.select("symbol", "v").mapInArrow(_block_pass([c for c, _ in blk], mat, float(t1), nearest), OUT_SCHEMA)
    parts.append(reliable(held) if parts else held)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    if len(parts) == 1:
        return allp
    best = F.min(F.struct("nearest_dist", "nearest"))  # NaN is the largest double
    return allp.groupBy("symbol").agg(
        best.alias("b"), F.min("first").alias("first"), F.sum("n_within").cast("long").alias("n_within"),
        F.sum("n_computed").cast("long").alias("n_computed"),
    ).select("symbol", F.col("b.nearest").alias("nearest"), F.col("b.nearest_dist").alias("nearest_dist"),
             "first", "n_within", "n_computed")
