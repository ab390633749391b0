"""k-means restricted to canopies: a vector only considers the centres of its own canopy.

One Spark job per round; members are written once and cached, and only the K
new centre rows are materialised per round, so lineage stays flat and members
are never rewritten.  Each round computes, for every vector, its nearest
current centre, counts changed assignments, and averages per centre by partial
aggregation.  The numpy engines search the previous round's centres only in
canopies whose centres moved, and no distance at all in canopies of one centre.
The final assignment is computed once and written.

Small model (K x d doubles under ``model_bytes``): centre rows are held on the
driver (as MLlib's k-means does) and the default engine assigns each Arrow
batch with vectorised numpy, emitting only per-centre partial sums.
Large model: centres stay in written tables.  Members get a per-canopy salt
(ceil(n_i / rows_per_group) salts per canopy), are hash-partitioned on
(canopy_id, salt) once, and each round cogroups them with the canopy's
centres (copied once per salt), running the same numpy code per group; so a
canopy holding a third of all vectors is split into bounded groups.
``engine="jvm"`` instead joins per-canopy centre arrays (broadcast under
``broadcast_bytes``, else salted) and evaluates a JVM array expression.

Ties: distances are snapped to multiples of 1e-12 (identical double arithmetic
in every engine and in the SQL oracle), then the lowest center_id wins.
Stop: no assignment changed since the previous round; there is no default cap. Centres that come back
to an earlier state while assignments still change would go round for ever: that raises, as does a ``max_iter`` that is reached.
A centre that loses all members keeps its previous vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Hashable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from quiver.functions.distance import mean_l1, mean_l1_matrix
from quiver.functions.vectors import arrow_matrix
from quiver.operators.joins import attach_by_canopy, salt_by_count
from quiver.operators.persist import reliable

# Fixed value: distances are snapped to multiples of 1e-12 before comparing
# (near-tie guard), as floor(x * 1e12 + 0.5) / 1e12 in every engine.
SNAP = 1e12
# Fixed value: longest vector averaged with one aggregate per element.
WIDE_DIM = 64


@dataclass
class KMeansResult:
    assignments: DataFrame  # symbol, canopy_id, center_id, dist
    centers: DataFrame  # center_id, canopy_id, v
    rounds: int
    changed: list[int]
    n_centers: int

    @property
    def converged(self) -> bool:
        """Whether the last round changed no assignment."""
        return len(self.changed) > 1 and self.changed[-1] == 0


def centre_arrays(centers: DataFrame, name: str) -> DataFrame:
    """(center_id, canopy_id, v) -> (canopy_id, name: array<struct<cid, v>>) sorted by cid."""
    return centers.groupBy("canopy_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("center_id").alias("cid"), F.col("v").alias("v")))).alias(name)
    )


def snap(x: Column) -> Column:
    """floor(x * 1e12 + 0.5) / 1e12 in doubles (x >= 0; NaN stays NaN)."""
    y = x * F.lit(SNAP) + F.lit(0.5)
    return (y - y % F.lit(1.0)) / F.lit(SNAP)


def snap_np(x: np.ndarray) -> np.ndarray:
    return np.floor(x * SNAP + 0.5) / SNAP


def nearest(cs: Column, v: Column) -> Column:
    """Struct (d, cid) of the nearest centre in ``cs``; ties -> lowest cid."""
    return F.array_min(F.transform(cs, lambda c: F.struct(
        snap(mean_l1(c["v"], v)).alias("d"), c["cid"].alias("cid"))))


def assign(members: DataFrame, centers: DataFrame, dim: int, n_centers: int,
           broadcast_bytes: int = 64 << 20, salts: int = 64) -> DataFrame:
    """Nearest centre of the own canopy -> (symbol, canopy_id, center_id, dist)."""
    arrays = centre_arrays(centers, "cs")
    joined = attach_by_canopy(members, arrays, n_centers * (dim * 8 + 48), broadcast_bytes, salts)
    near = joined.select("symbol", "canopy_id", nearest(F.col("cs"), F.col("v")).alias("nn"))
    return near.select("symbol", "canopy_id", F.col("nn.cid").cast("long").alias("center_id"),
                       F.col("nn.d").alias("dist"))


def _tag_and_aggregate(joined: DataFrame, has_prev: bool, dim: int) -> DataFrame:
    """Nearest current / previous centre per vector, then per-centre means and change counts.

    -> (center_id, new_v, n, changed).  Vectors up to ``WIDE_DIM`` long use one
    ``avg`` per element; longer ones are exploded to (centre, position) pairs
    and averaged in one partial aggregation, then reassembled (K x d rows).
    """
    # coalesce: a non-null key stops Spark from inferring an is-not-null join
    # filter that would evaluate the distance lambdas a second time.
    a_cur = F.coalesce(nearest(F.col("cs"), F.col("v"))["cid"], F.lit(-1).cast("long"))
    a_prev = nearest(F.col("ps"), F.col("v"))["cid"] if has_prev else F.lit(None).cast("long")
    tagged = joined.select(a_cur.alias("center_id"), a_prev.alias("prev_id"), "v")
    moved = F.col("prev_id").isNull() | (F.col("prev_id") != F.col("center_id"))
    if dim <= WIDE_DIM:
        means = [F.avg(F.col("v")[j]) for j in range(dim)]
        return tagged.groupBy("center_id").agg(
            F.array(*means).alias("new_v"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(moved).alias("changed"),
        )
    cells = tagged.select("center_id", moved.alias("moved"), F.posexplode("v").alias("pos", "x"))
    per_pos = cells.groupBy("center_id", "pos").agg(
        F.avg("x").alias("x"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("moved").alias("changed"),
    )
    return per_pos.groupBy("center_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias("new_v"),
        F.max("n").alias("n"),
        F.max("changed").alias("changed"),
    )


def _round(members: DataFrame, cur: DataFrame, prev: DataFrame | None, dim: int, n_centers: int,
           broadcast_bytes: int, salts: int) -> DataFrame:
    """One assign+update round on centre tables -> (center_id, canopy_id, v, n, changed) per centre."""
    arrays = centre_arrays(cur, "cs")
    factor = 1
    if prev is not None:
        arrays = arrays.join(centre_arrays(prev, "ps"), "canopy_id")
        factor = 2
    joined = attach_by_canopy(members, arrays, factor * n_centers * (dim * 8 + 48), broadcast_bytes, salts)
    stats = _tag_and_aggregate(joined, prev is not None, dim)
    return cur.join(stats, "center_id", "left").select(
        "center_id", "canopy_id",
        F.coalesce(F.col("new_v"), F.col("v")).alias("v"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
        F.coalesce(F.col("changed"), F.lit(0)).cast("long").alias("changed"),
    )


CENTERS_SCHEMA = "center_id bigint, canopy_id string, v array<double>"
ROUND_SCHEMA = CENTERS_SCHEMA + ", n bigint, changed bigint"
ARRAYS_SCHEMA = ("canopy_id string, cs array<struct<cid: bigint, v: array<double>>>, "
                 "ps array<struct<cid: bigint, v: array<double>>>")


def _model_arrays(spark, cur: list, prev: list | None) -> DataFrame:
    """Per-canopy centre arrays built from centre rows held on the driver (bounded)."""
    by_canopy: dict[str, list] = {}
    for cid, can, v in cur:
        by_canopy.setdefault(can, [[], []])[0].append((cid, v))
    for cid, can, v in prev or []:
        by_canopy[can][1].append((cid, v))
    rows = [(can, sorted(c), sorted(p) if prev is not None else None) for can, (c, p) in by_canopy.items()]
    return spark.createDataFrame(rows, ARRAYS_SCHEMA)


# ---------------------------------------------------------------- numpy engine
# Used when the model (K centres) is held on the driver: the per-canopy centre
# matrices travel in the task closure (PySpark broadcasts closures over 1 MB),
# each Arrow batch of members is assigned with vectorised numpy, and only
# per-centre partial sums leave the task, so Spark's shuffle carries at most
# K x (d + 2) values per batch.  Same distance, snap and tie rule as the JVM
# expression, so both engines assign identically.

STATS_SCHEMA = "center_id long, pos int, value double"
ASSIGN_SCHEMA = "symbol string, canopy_id string, center_id long, dist double"
_STATS_ARROW = pa.schema([("center_id", pa.int64()), ("pos", pa.int32()), ("value", pa.float64())])
_ASSIGN_ARROW = pa.schema([("symbol", pa.string()), ("canopy_id", pa.string()), ("center_id", pa.int64()), ("dist", pa.float64())])
_BLOCK_DOUBLES = 4_000_000


def _np_model(rows: list) -> dict:
    """[(cid, canopy, v)] -> {canopy: (ids sorted, k x d matrix)}."""
    out: dict = {}
    for cid, can, v in sorted(rows):
        ids, vs = out.setdefault(can, ([], []))
        ids.append(cid)
        vs.append(v)
    return {c: (np.asarray(i, dtype=np.int64), np.asarray(v, dtype=np.float64)) for c, (i, v) in out.items()}


def _np_nearest(rows: np.ndarray, ids: np.ndarray, mat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre id and snapped distance per row; ties and rows without a distance take the lowest id."""
    out_id = np.empty(rows.shape[0], dtype=np.int64)
    out_d = np.empty(rows.shape[0], dtype=np.float64)
    step = max(1, _BLOCK_DOUBLES // max(1, mat.shape[0]))
    for a in range(0, rows.shape[0], step):
        dist = snap_np(mean_l1_matrix(rows[a:a + step], mat))
        j = np.argmin(np.where(np.isnan(dist), np.inf, dist), axis=1)
        out_id[a:a + step] = ids[j]
        out_d[a:a + step] = dist[np.arange(dist.shape[0]), j]
    return out_id, out_d


def _by_canopy(cans: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """(canopy, row numbers) of a batch, each row once."""
    names, inv = np.unique(cans, return_inverse=True)
    order = np.argsort(inv, kind="stable")
    for can, idx in zip(names, np.split(order, np.cumsum(np.bincount(inv, minlength=len(names)))[:-1])):
        yield can, idx


def _np_ids(vecs: np.ndarray, cans: np.ndarray, cur: dict, prev: dict | None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest current centre of every row (-1 without one) and whether the previous centres gave another."""
    cid = np.full(len(vecs), -1, dtype=np.int64)
    moved = np.full(len(vecs), prev is None)
    for can, idx in _by_canopy(cans):
        if can not in cur:
            continue
        ids, mat = cur[can]
        if len(ids) == 1:
            cid[idx] = ids[0]
            continue
        cid[idx] = _np_nearest(vecs[idx], ids, mat)[0]
        if prev is not None and not np.array_equal(mat, prev[can][1], equal_nan=True):
            moved[idx] = _np_nearest(vecs[idx], *prev[can])[0] != cid[idx]
    return cid, moved


def _np_sums(vecs: np.ndarray, cid: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre ids and one row (count, changed, element sums) per id."""
    uniq, inv = np.unique(cid, return_inverse=True)
    order = np.argsort(inv, kind="stable")
    starts = np.searchsorted(inv[order], np.arange(len(uniq)))
    n = np.bincount(inv, minlength=len(uniq)).astype(np.float64)
    ch = np.bincount(inv, weights=moved.astype(np.float64), minlength=len(uniq))
    return uniq, np.concatenate([n[:, None], ch[:, None], np.add.reduceat(vecs[order], starts, axis=0)], axis=1)


def _cells(ids: np.ndarray, sums: np.ndarray) -> dict:
    """(center_id, pos, value) columns; pos -2 = count, -1 = changed."""
    width = sums.shape[1]
    return {"center_id": np.repeat(ids, width), "pos": np.tile(np.arange(-2, width - 2, dtype=np.int32), len(ids)),
            "value": sums.ravel()}


def _np_round_stats(cur: dict, prev: dict | None, dim: int):
    """mapInArrow body: the (center_id, pos, value) sums of a whole task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ids = np.sort(np.concatenate([ids for ids, _ in cur.values()]))
        total = np.zeros((len(all_ids), dim + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            vecs = arrow_matrix(batch.column("v"))
            cid, moved = _np_ids(vecs, batch.column("canopy_id").to_numpy(zero_copy_only=False), cur, prev)
            known = cid >= 0
            if known.any():
                ids, sums = _np_sums(vecs[known], cid[known], moved[known])
                total[np.searchsorted(all_ids, ids)] += sums
        seen = total[:, 0] > 0
        yield pa.RecordBatch.from_pydict(_cells(all_ids[seen], total[seen]), schema=_STATS_ARROW)

    return run


def _np_assigned(symbols, cans: np.ndarray, vecs: np.ndarray, model: dict) -> dict:
    cid, dist = np.full(len(vecs), -1, dtype=np.int64), np.full(len(vecs), np.nan)
    for can, idx in _by_canopy(cans):
        if can in model:
            cid[idx], dist[idx] = _np_nearest(vecs[idx], *model[can])
    return {"symbol": symbols, "canopy_id": cans, "center_id": cid, "dist": dist}


def _np_assign(model: dict):
    """mapInArrow body: the nearest centre of every member and its distance (NaN stays NaN)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cans = batch.column("canopy_id").to_numpy(zero_copy_only=False)
                out = _np_assigned(batch.column("symbol"), cans, arrow_matrix(batch.column("v")), model)
                yield pa.RecordBatch.from_pydict(out, schema=_ASSIGN_ARROW)

    return run


# ---------------------------------------------------------------- large models
# Centres stay in tables.  Members and centres are cogrouped on
# (canopy_id, salt): canopy i gets ceil(n_i / rows_per_group) salts, members
# take a salt from their symbol hash, and each canopy's centres (current and
# previous round) are copied once per salt.  A group therefore holds a bounded
# slice of one canopy's members plus that canopy's centres, and is processed
# with the same numpy code as the small-model engine.


def _group_model(centres: pa.Table, which: int) -> dict:
    """The centres of one group's canopy in one round, as the small-model engine holds them."""
    part = centres.filter(pc.equal(centres["which"], which)).sort_by("center_id").combine_chunks()
    if not part.num_rows:
        return {}
    return {part["canopy_id"][0].as_py(): (part["center_id"].to_numpy(), _table_matrix(part))}


def _table_matrix(table: pa.Table) -> np.ndarray:
    return np.concatenate([arrow_matrix(c) for c in table["v"].chunks if len(c)])


def _cogroup_stats(has_prev: bool):
    def run(members: pa.Table, centres: pa.Table) -> pa.Table:
        cur = _group_model(centres, 0)
        if not members.num_rows or not cur:
            return _STATS_ARROW.empty_table()
        vecs = _table_matrix(members)
        cid, moved = _np_ids(vecs, members["canopy_id"].to_numpy(), cur, _group_model(centres, 1) if has_prev else None)
        return pa.Table.from_pydict(_cells(*_np_sums(vecs, cid, moved)), schema=_STATS_ARROW)

    return run


def _salt_members(members: DataFrame, rows_per_group: int) -> tuple[DataFrame, DataFrame]:
    """Members with a per-canopy salt, hash-partitioned on (canopy_id, salt) once and cached.

    Later cogroups reuse this partitioning and only the small centre side is
    shuffled per round.
    """
    m, salts = salt_by_count(members, "canopy_id", rows_per_group)
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = m.repartition(parts, "canopy_id", "__salt").persist(StorageLevel.MEMORY_AND_DISK)
    return m, salts


def _centre_side(cur: DataFrame, prev: DataFrame | None, salts: DataFrame) -> DataFrame:
    both = cur.select("center_id", "canopy_id", "v", F.lit(0).alias("which"))
    if prev is not None:
        both = both.unionByName(prev.select("center_id", "canopy_id", "v", F.lit(1).alias("which")))
    return both.join(salts, "canopy_id").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.col("__s") - 1))).drop("__s")


def _round_cogroup(m: DataFrame, salts: DataFrame, cur: DataFrame, prev: DataFrame | None, dim: int) -> DataFrame:
    """One round on centre tables -> (center_id, canopy_id, v, n, changed) for every centre."""
    c = _centre_side(cur, prev, salts)
    stats = (m.groupBy("canopy_id", "__salt").cogroup(c.groupBy("canopy_id", "__salt"))
             .applyInArrow(_cogroup_stats(prev is not None), STATS_SCHEMA)
             .groupBy("center_id", "pos").agg(F.sum("value").alias("s")))
    per = stats.groupBy("center_id").agg(
        F.max(F.when(F.col("pos") == -2, F.col("s"))).alias("n"),
        F.max(F.when(F.col("pos") == -1, F.col("s"))).alias("changed"),
        F.array_sort(F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", "s")))).alias("cells"),
    ).select("center_id", "n", "changed", F.transform("cells", lambda e: e["s"]).alias("sums"))
    return cur.join(per, "center_id", "left").select(
        "center_id", "canopy_id",
        F.when(F.col("n") > 0, F.transform("sums", lambda x: x / F.col("n"))).otherwise(F.col("v")).alias("v"),
        F.coalesce(F.col("n"), F.lit(0.0)).cast("long").alias("n"),
        F.coalesce(F.col("changed"), F.lit(0.0)).cast("long").alias("changed"),
    )


def _assign_cogroup(m: DataFrame, salts: DataFrame, centers: DataFrame) -> DataFrame:
    c = _centre_side(centers, None, salts)

    def run(mem: pa.Table, cen: pa.Table) -> pa.Table:
        if not mem.num_rows:
            return _ASSIGN_ARROW.empty_table()
        out = _np_assigned(mem["symbol"], mem["canopy_id"].to_numpy(), _table_matrix(mem), _group_model(cen, 0))
        return pa.Table.from_pydict(out, schema=_ASSIGN_ARROW)

    return (m.groupBy("canopy_id", "__salt").cogroup(c.groupBy("canopy_id", "__salt"))
            .applyInArrow(run, ASSIGN_SCHEMA))


def _rounds(max_iter: int | None) -> Iterator[int]:
    return iter(range(1, int(max_iter) + 1)) if max_iter is not None else count(1)


def _state(cur: list) -> bytes:
    """Digest of the centres to 12 places, the grain of the distances."""
    digest = hashlib.md5()
    for _, _, v in cur:
        digest.update((np.round(np.array(v, float), 12) + 0.0).tobytes())
    return digest.digest()


def _check_cycle(seen: dict[Hashable, int], state: Hashable, i: int) -> None:
    """A state of two or more rounds ago comes back: the rounds between would repeat for ever."""
    if i - seen.setdefault(state, i) >= 2:
        raise RuntimeError(f"k-means does not converge: the centres after round {i} are those after round {seen[state]}")


def _converged(result: KMeansResult, stop_on_convergence: bool, max_iter: int | None) -> KMeansResult:
    if stop_on_convergence and max_iter is not None and result.n_centers and not result.converged:
        raise RuntimeError(f"k-means stopped after {result.rounds} rounds without converging; raise max_iter or leave it out")
    return result


def kmeans(members: DataFrame, initial: DataFrame, dim: int, max_iter: int | None = None,
           broadcast_bytes: int = 64 << 20, salts: int = 64, stop_on_convergence: bool = True,
           checkpoint_members: bool = True, model_bytes: int = 16 << 20,
           centers_path: str | None = None, engine: str = "auto",
           rows_per_group: int = 1_000_000) -> KMeansResult:
    """Iterate assign/update from ``initial`` (center_id, canopy_id, v) centres.

    When the model (K centres x d doubles) is under ``model_bytes`` the K new
    centre rows come back to the driver each round and the next round's
    per-canopy arrays are built from them (as MLlib's k-means does): one job per
    round.  Larger models stay in written centre tables, never on the driver.
    Without ``max_iter`` the rounds go on until no assignment changes; where it is given
    and reached before that, the run raises unless ``stop_on_convergence`` is off.
    ``centers_path``: also keep every round's centres as ``<path>/iter=<i>``, with their
    members ``n`` and how many of them ``changed`` to the centre in that round.
    ``engine``: 'auto' = numpy over Arrow batches when the model is on the
    driver (measured ~6x faster per round than the lambda expression at 1.5M
    vectors), else the JVM expression; 'jvm' forces the JVM expression.
    """
    spark = members.sparkSession
    members = members.select("symbol", "canopy_id", "v")
    if checkpoint_members:
        members = reliable(members)
    # Cached for the rounds; a lost block is re-read from the written table.
    members = members.persist(StorageLevel.MEMORY_AND_DISK)
    init = initial.select(F.col("center_id").cast("long"), "canopy_id", "v")
    n_centers = init.count()
    on_driver = n_centers * (dim * 8 + 48) <= model_bytes
    cur_df = init if on_driver else reliable(init)
    changed: list[int] = []
    rounds = 0
    if engine not in ("auto", "jvm"):
        raise ValueError("engine must be 'auto' or 'jvm'")
    use_numpy = on_driver and engine == "auto"
    if on_driver:
        cur = sorted((r["center_id"], r["canopy_id"], list(r["v"])) for r in cur_df.collect())
        prev = None
        seen: dict[Hashable, int] = {_state(cur): 0}
        for i in _rounds(max_iter):
            if use_numpy and cur:
                fn = _np_round_stats(_np_model(cur), _np_model(prev) if prev is not None else None, dim)
                parts = (members.mapInArrow(fn, STATS_SCHEMA)
                         .groupBy("center_id", "pos").agg(F.sum("value").alias("s")).collect())
                acc: dict[int, np.ndarray] = {}
                for r in parts:
                    acc.setdefault(r["center_id"], np.zeros(dim + 2))[r["pos"] + 2] = r["s"]
                stats = {cid: {"new_v": (a[2:] / a[0]).tolist(), "n": int(a[0]), "changed": int(a[1])} for cid, a in acc.items() if a[0] > 0}
            else:
                arrays = _model_arrays(spark, cur, prev)
                joined = members.join(F.broadcast(arrays), "canopy_id")
                stats = {r["center_id"]: r for r in _tag_and_aggregate(joined, prev is not None, dim).collect()}
            ch = int(sum(r["changed"] for r in stats.values()))
            changed.append(ch)
            rounds = i
            nxt = [(cid, can, list(stats[cid]["new_v"]) if cid in stats else v) for cid, can, v in cur]
            if centers_path:
                counted = [(*c, *((int(stats[c[0]]["n"]), int(stats[c[0]]["changed"])) if c[0] in stats else (0, 0))) for c in nxt]
                spark.createDataFrame(counted, ROUND_SCHEMA).write.mode("overwrite").parquet(f"{centers_path}/iter={i}")
            prev, cur = cur, nxt
            if stop_on_convergence and i >= 2 and ch == 0:
                break
            if stop_on_convergence:
                _check_cycle(seen, _state(cur), i)
        centers = spark.createDataFrame(cur, CENTERS_SCHEMA)
        last_rows = prev if prev is not None else cur
        if use_numpy:
            final = members.mapInArrow(_np_assign(_np_model(last_rows)), ASSIGN_SCHEMA)
        else:
            final = assign(members, spark.createDataFrame(last_rows, CENTERS_SCHEMA), dim, n_centers,
                           broadcast_bytes, salts)
        final = reliable(final)  # computed once, while the members are cached
        members.unpersist(blocking=False)
        return _converged(KMeansResult(final, centers, rounds, changed, n_centers), stop_on_convergence, max_iter)
    cur_t, prev_t = cur_df, None
    salted = _salt_members(members, rows_per_group) if engine == "auto" else None
    seen = {}
    for i in _rounds(max_iter):
        if salted is not None:
            nxt = reliable(_round_cogroup(salted[0], salted[1], cur_t, prev_t, dim))
        else:
            nxt = reliable(_round(members, cur_t, prev_t, dim, n_centers, broadcast_bytes, salts))
        if centers_path:
            nxt.select("center_id", "canopy_id", "v", "n", "changed").write.mode("overwrite").parquet(f"{centers_path}/iter={i}")
        grain = F.transform("v", lambda x: F.round(x, 12) + F.lit(0.0))
        total = nxt.agg(F.sum("changed"), F.sum(F.xxhash64("center_id", grain).cast("decimal(20,0)"))).first()
        ch = int(total[0] or 0)
        changed.append(ch)
        rounds = i
        prev_t, cur_t = cur_t, nxt.select("center_id", "canopy_id", "v")
        if stop_on_convergence and i >= 2 and ch == 0:
            break
        if stop_on_convergence:
            _check_cycle(seen, total[1], i)
    last_t = prev_t if prev_t is not None else cur_t
    if salted is not None:
        final = reliable(_assign_cogroup(salted[0], salted[1], last_t))
        salted[0].unpersist(blocking=False)
    else:
        final = reliable(assign(members, last_t, dim, n_centers, broadcast_bytes, salts))
    members.unpersist(blocking=False)
    return _converged(KMeansResult(final, cur_t, rounds, changed, n_centers), stop_on_convergence, max_iter)
