"""Embedding near-duplicates by E8 lattice hashing.

Each table projects the unit vectors at random to ``BLOCKS`` times eight dimensions and decodes every block to its
nearest point of the E8 lattice; the points are the vector's home cell. E8 is two shifted copies of D8, so the
nearest point of the other copy is a neighbouring cell: a vector also probes the cells in which blocks are
replaced by it. Vectors that meet in a cell are compared by cosine in double precision.

Equal vectors form one class. A pair of classes counts in the first table, and there in the first cell, in which it
meets, so links are counted where they are found and leave a task as one sum per class and one edge per class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import components, local_stars, prepare, reliable

TABLES, BLOCKS, SCALE, SEED = 8, 2, 0.4, 20240
CELL_CAP = 4096  # vectors at home in a cell that are compared in one task; larger cells are dealt in parts, without loss
PAIRS = 100_000  # pairs compared at once


def _d8(x: np.ndarray) -> np.ndarray:
    """The nearest point of D8: whole numbers with an even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    err = x[odd] - r[odd]
    worst = np.argmax(np.abs(err), axis=1)
    r[odd, worst] += np.where(err[np.arange(len(odd)), worst] >= 0, 1, -1)
    return r


def e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest E8 point of each row of ``x``, and the nearest one of the other copy of D8; doubled, as int8 bits."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    swap = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    near, other = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    code = lambda p: np.clip(2 * p, -127, 127).astype(np.int8).view(np.int64).ravel()
    return code(near), code(other)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def cells(unit: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """Cell keys of unit vectors: (vectors, tables, 2 ** blocks), the home cell first."""
    n, d = unit.shape
    out = np.zeros((n, tables, 2**blocks), np.int64)
    for t in range(tables):
        lattice = np.random.default_rng([seed, d, t]).standard_normal((d, 8 * blocks))
        y = scale * (unit @ lattice)
        codes = [e8(y[:, 8 * b:8 * b + 8]) for b in range(blocks)]
        for c in range(2**blocks):
            h = np.full(n, d * 1000 + t, np.uint64)
            for b in range(blocks):
                h = _mix(h * np.uint64(31) + _mix(codes[b][c >> b & 1].view(np.uint64)))
            out[:, t, c] = h.view(np.int64)
    return out


def valid(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _pack(v: np.ndarray) -> bytes:
    """A unit-scaled vector's bytes; four per component where they hold it exactly."""
    f = v.astype(np.float32)
    return b"f" + f.tobytes() if np.array_equal(f.astype(np.float64), v) else b"d" + v.tobytes()


def _units(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, filled with zeros to one width, and their lengths."""
    width = np.array([(len(r) - 1) // (4 if r[:1] == b"f" else 8) for r in raw])
    out = np.zeros((len(raw), max(width, default=0)))
    by = {}
    for i, r in enumerate(raw):
        by.setdefault((r[:1], len(r)), []).append(i)
    for (kind, size), own in by.items():
        v = np.frombuffer(b"".join(raw[i] for i in own), np.uint8).reshape(len(own), size)[:, 1:].copy()
        v = v.view(np.float32 if kind == b"f" else np.float64).astype(np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)
        out[own, : v.shape[1]] = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    return out, width


def _spread(tables: int, blocks: int, scale: float):
    """Rows ``(cell, tab, role, cls, n, keys, v)`` for the home cell and each probed cell of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                cls, n = b.column(0).to_numpy(), b.column(1).to_numpy()
                raw = [_pack(np.asarray(v, np.float64)) for v in b.column(2).to_pylist()]
                unit, width = _units(raw)
                for d in np.unique(width).tolist():
                    own = np.flatnonzero(width == d)
                    keys = cells(unit[own, :d], tables, blocks, scale)
                    rep = 2**blocks
                    body = pa.array([k.tobytes() for k in keys], pa.binary())
                    idx = np.repeat(np.arange(len(own)), tables * rep)
                    cols = [pa.array(keys.ravel()), pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), rep), len(own))),
                            pa.array(np.tile(np.where(np.arange(rep) == 0, 0, 2).astype(np.int32), len(own) * tables)),
                            pa.array(cls[own][idx]), pa.array(n[own][idx]), body.take(pa.array(idx)), pa.array([raw[i] for i in own], pa.binary()).take(pa.array(idx))]
                    yield pa.RecordBatch.from_arrays(cols, names=["cell", "tab", "role", "cls", "n", "keys", "v"])

    return run


def _compare(threshold: float, tables: int, probes: int):
    """Links inside cells; rows arrive sorted by (cell, tab, part, role), those at home first.

    Gives ``(a, b, null)`` for edges and ``(a, null, n)`` for the vectors linked to the class ``a``."""

    def fresh(x: np.ndarray, y: np.ndarray, tab: np.ndarray, home_home: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
        """Whether the pairs meet here first. ``x``, ``y``: all cells of either side."""
        here = np.ones(len(tab), bool)
        for s in range(tables):
            met = (y[:, s, 0:1] == x[:, s, :]).any(axis=1) | (x[:, s, 0:1] == y[:, s, :]).any(axis=1)
            here &= ~(met & (s < tab))
        at = np.arange(len(tab))
        mutual = ~home_home & (y[at, tab, 1:] == x[at, tab, 0:1]).any(axis=1)  # y, at home here, probes the home of x too
        return here & ~(mutual & (cx > cy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [*[np.zeros(0, np.int64)] * 6, np.zeros((0, tables, probes), np.int64), []]
        for b in batches:
            if not b.num_rows:
                continue
            old = len(held[0])
            cell, tab, part, role, cls, n = (np.concatenate([held[k], b.column(k).to_numpy().astype(np.int64)]) for k in range(6))
            keys = np.concatenate([held[6], np.frombuffer(b"".join(b.column(6).to_pylist()), np.int64).reshape(-1, tables, probes)])
            raw = held[7] + b.column(7).to_pylist()
            unit, width = _units(raw)
            start = np.concatenate([[True], (cell[1:] != cell[:-1]) | (tab[1:] != tab[:-1]) | (part[1:] != part[:-1])])
            group = np.cumsum(start) - 1
            home = np.flatnonzero(role == 0)
            before = np.concatenate([[0], np.cumsum(role == 0)])
            lo = before[np.flatnonzero(start)][group]
            count = before[:-1] - lo  # those at home in the cell that come before the row
            count[:old] = 0
            todo = np.flatnonzero(count)
            a, e, who, add = [], [], [], []
            for rows in np.split(todo, np.flatnonzero(np.diff(np.cumsum(count[todo]) // PAIRS)) + 1):
                c = count[rows]
                x = np.repeat(rows, c)
                y = home[np.repeat(lo[rows] - np.cumsum(c) + c, c) + np.arange(c.sum())]
                own = (cls[x] != cls[y]) & (width[x] == width[y])
                x, y = x[own], y[own]
                cos = np.concatenate([np.einsum("ij,ij->i", unit[x[q:q + 20_000]], unit[y[q:q + 20_000]]) for q in range(0, len(x), 20_000)] or [np.zeros(0)])
                x, y = x[cos >= threshold], y[cos >= threshold]
                own = fresh(keys[x], keys[y], tab[x], role[x] < 2, cls[x], cls[y])
                x, y = x[own], y[own]
                a.append(cls[x])
                e.append(cls[y])
                who += [cls[x], cls[y]]
                add += [n[y], n[x]]
            if sum(map(len, a)):
                p, q = local_stars(np.concatenate(a), np.concatenate(e))
                node, back = np.unique(np.concatenate(who), return_inverse=True)
                linked = np.bincount(back, weights=np.concatenate(add)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p, node])), pa.concat_arrays([pa.array(q), pa.nulls(len(node), pa.int64())]),
                                                  pa.concat_arrays([pa.nulls(len(p), pa.int64()), pa.array(linked)])], names=["a", "b", "n"])
            own = np.flatnonzero((group == group[-1]) & (role == 0))  # at most a cell's cap
            held = [*(x[own] for x in (cell, tab, part, role, cls, n)), keys[own], [raw[k] for k in own]]

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, tables: int = TABLES,
                    blocks: int = BLOCKS, scale: float = SCALE, cap: int = CELL_CAP) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Pairs that share a home or probed cell are linked if their cosine is at least ``threshold``, none below it.
    ``component_id`` is the smallest id reachable over links; ``kept`` marks it. Vectors that are null, empty, zero
    or hold null or non-finite components, and rows with a null id, link with nothing (``kept`` is null for a
    null id); vectors of different lengths never link. Rows with one id and rows with equal vectors each count as a
    vector. Other columns are not read, whatever their names. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    own = own.withColumn("ok", valid(F.col("v")) & F.col("vec_id").isNotNull())
    classes = own.where("ok").groupBy("v").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    classes = reliable(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    rows = classes.select("cls", "n", "v").mapInArrow(_spread(tables, blocks, scale), "cell long, tab int, role int, cls long, n long, keys binary, v binary")
    rows = rows.withColumn("part", F.lit(0))
    home = classes.select("cls", "n", "v").mapInArrow(_homes(tables, blocks, scale), "cell long, tab int").groupBy("cell", "tab").count()
    large = reliable(home.where(F.col("count") > cap).select("cell", "tab", F.ceil(F.col("count") / cap).cast("int").alias("parts")), "cells")
    if large.head(1):
        rows = rows.drop("part").join(large, ["cell", "tab"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        at = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
        rows = rows.withColumn("at", F.when(F.col("role") == 0, at).otherwise(F.lit(0)))
        # at home in one part; those of earlier parts come to each later one, and so does every prober to all
        rows = rows.withColumn("part", F.explode(F.sequence("at", F.col("parts") - 1)))
        rows = rows.withColumn("role", F.when((F.col("role") == 0) & (F.col("part") > F.col("at")), 1).otherwise(F.col("role")))
    dealt = rows.select("cell", "tab", "part", "role", "cls", "n", "keys", "v").repartition("cell", "tab", "part").sortWithinPartitions("cell", "tab", "part", "role")
    found = reliable(dealt.mapInArrow(_compare(threshold, tables, 2**blocks), "a long, b long, n long"), "links")
    comp = components(found.where("b is not null").select("a", "b"), "lattice")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    label = (classes.select("cls", "n", "low", "v").join(links, F.col("cls") == F.col("a"), "left").join(comp, F.col("cls") == F.col("node"), "left")
             .select("v", "low", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cls").alias("root")))
    least = label.groupBy("root").agg(F.min("low").alias("component"))
    label = label.join(least, "root").select(F.col("v").alias("w"), (F.col("links") + F.col("n") - 1).alias("links"), "component")
    joined = own.where("ok").join(label, F.col("v") == F.col("w")).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = own.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _homes(tables: int, blocks: int, scale: float):
    spread = _spread(tables, blocks, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in spread(batches):
            home = b.filter(pc.equal(b.column(2), 0))
            yield home.select(["cell", "tab"])

    return run
