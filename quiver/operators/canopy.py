"""Canopy pre-clustering under mean-L1 distance with one threshold T1 (strict ``<``).

Semantics (sequential greedy): visit vectors in symbol order; a vector joins
the first existing centre (creation order) within T1, otherwise it becomes a
centre.  ``canopy_id`` is the centre's symbol.

Exact distributed form (``canopy``): vectors with NaN are their own canopies and are
set aside in one filter; the others are written once in ranges of symbols, then
rounds over the undecided ones:
  1. take the B smallest undecided symbols and run the greedy pass over them in
     one bounded task.  Counts per range tell which ranges hold them, so only
     those are read and fewer than B rows beyond the batch meet in that task;
  2. label every remaining undecided vector in parallel with the first of that
     round's new centres (at most B) within T1.
Every undecided vector is farther than T1 from all earlier centres, so step 1
decides its batch exactly as the sequential pass would, and step 2 is the
sequential rule for later vectors.  Each round decides at least B vectors; the
batch doubles up to ``max_batch`` when rounds are centre-heavy.  A round is
written to its own folder of one table, split into decided and undecided rows, so
the result is one scan however many rounds there were and a lost executor
recomputes from the shared folder, not from the start.

Bucketed form (``canopy_bucketed``, the local pass + merge of the original
design): vectors are hashed into buckets, each bucket runs the greedy pass
locally, then the local centres are canopied again (exact form) and every
member follows its local centre to the surviving one, so members may lie up
to 2*T1 from their canopy centre.  ``canopy_tree`` merges over more than one level,
so the pass over all centres sees only those that survived the levels before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quiver.functions.distance import CentreIndex, mean_l1_to_rows
from quiver.functions.vectors import arrow_matrix, has_nan
from quiver.operators.persist import reliable
from quiver.session import scratch_path

OUT_SCHEMA = "symbol string, canopy_id string, v array<double>"
# Upper bound on the working set of one distance block, in doubles.
_BLOCK_DOUBLES = 4_000_000


class _Centres:
    """Growing centre matrix kept in creation order."""

    def __init__(self) -> None:
        self.ids: list[str] = []
        self.mat: np.ndarray | None = None
        self.n = 0

    def first_within(self, x: np.ndarray, t1: float, start: int = 0) -> str | None:
        """The first centre from place ``start`` on that lies within T1."""
        if self.n == start:
            return None
        hit = np.flatnonzero(mean_l1_to_rows(x, self.mat[start: self.n]) < t1)
        return self.ids[start + hit[0]] if hit.size else None

    def add(self, sym: str, x: np.ndarray) -> None:
        if self.mat is None:
            self.mat = np.empty((64, x.shape[0]), dtype=np.float64)
        elif self.n == self.mat.shape[0]:
            self.mat = np.vstack([self.mat, np.empty_like(self.mat)])
        self.mat[self.n] = x
        self.ids.append(sym)
        self.n += 1


def _with_canopies(batch: pa.RecordBatch, labels: list) -> pa.RecordBatch:
    """(symbol, canopy_id, v, other columns) in the order of the output schemas."""
    cols = {"symbol": batch.column("symbol"), "canopy_id": pa.array(labels, type=pa.string()), "v": batch.column("v")}
    cols.update({c: batch.column(c) for c in batch.schema.names if c not in cols})
    return pa.RecordBatch.from_pydict(cols)


def greedy_pass(t1: float, reset_on: str | None = None, max_centres: int | None = None):
    """mapInArrow body: sequential greedy canopy over rows already sorted by symbol.

    With ``reset_on`` the centre set restarts whenever that column changes
    (one independent pass per bucket).  State is the centre set only.  Once it holds
    ``max_centres``, a vector that none of them takes stays open (null canopy_id): its
    canopy is created later than all of these, so a further pass over the open rows
    goes on exactly where this one stopped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = _Centres()
        current = object()
        for batch in batches:
            keys = batch.column(reset_on).to_pylist() if reset_on else None
            symbols, rows = batch.column("symbol").to_pylist(), arrow_matrix(batch.column("v"))
            labels: list = [None] * len(symbols)
            starts = [0] if keys is None else [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
            for a, b in zip(starts, starts[1:] + [len(symbols)]):
                if keys and keys[a] != current:
                    centres, current = _Centres(), keys[a]
                # centres of earlier batches in one go, those created on the way one by one
                known = centres.n
                found = _first_within(rows[a:b], centres.mat[:known], t1) if known else np.full(b - a, -1)
                for i in range(a, b):
                    j = found[i - a]
                    cid = centres.ids[j] if j >= 0 else centres.first_within(rows[i], t1, known)
                    if cid is None and (max_centres is None or centres.n < max_centres):
                        centres.add(symbols[i], rows[i])
                        cid = symbols[i]
                    labels[i] = cid
            yield _with_canopies(batch, labels)

    return run


def _first_within(rows: np.ndarray, centres: np.ndarray, t1: float) -> np.ndarray:
    """Per row the place of the first centre within T1, -1 where there is none."""
    m, d = rows.shape
    found = np.full(m, -1, dtype=np.int64)
    block = max(1, _BLOCK_DOUBLES // max(1, m * d))
    for start in range(0, len(centres), block):
        open_rows = np.flatnonzero(found < 0)
        if open_rows.size == 0:
            break
        near, _ = CentreIndex(centres[start:start + block], pivots=0).distances(rows[open_rows], t1)
        hit = near < t1
        any_hit = hit.any(axis=1)
        found[open_rows[any_hit]] = start + hit[any_hit].argmax(axis=1)
    return found


def label_with_centres(ids: list[str], mat: np.ndarray, t1: float):
    """mapInArrow body: first centre (in the given order) within T1, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _first_within(arrow_matrix(batch.column("v")), mat, t1)
            yield _with_canopies(batch, [ids[i] if i >= 0 else None for i in found])

    return run


def check_vectors(vectors: DataFrame) -> int:
    """Validate unique symbols and one common non-null vector length; return it (0 if empty)."""
    row = vectors.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi"),
                      F.count_if(F.col("v").isNull()).alias("nulls"),
                      F.count(F.lit(1)).alias("n"), F.count_distinct("symbol").alias("symbols")).first()
    if not row["n"]:
        return 0
    if row["nulls"] or row["lo"] != row["hi"] or row["lo"] < 1:
        raise ValueError(f"vectors must be non-null with one common length, got {row['lo']}..{row['hi']}")
    if row["symbols"] != row["n"]:
        raise ValueError(f"symbols must be unique: {row['n']} vectors, {row['symbols']} symbols")
    return int(row["lo"])


_ROUND_SCHEMA = "symbol string, canopy_id string, v array<double>, rng int, decided int"


def canopy(vectors: DataFrame, t1: float = 0.5, batch: int = 2048, max_batch: int = 32768,
           check: bool = True, materialized: bool = False, batch_bytes: int = 64 << 20) -> DataFrame:
    """Exact sequential-greedy canopies -> (symbol, canopy_id, v), read from written tables.

    ``materialized``: ``vectors`` is already a written table (no copy is made).
    ``batch`` and ``max_batch`` bound the rows and ``batch_bytes`` the bytes that one task and
    the driver hold of a round; none of them changes the result.
    """
    spark = vectors.sparkSession
    source = vectors.select("symbol", "v")
    if not materialized:
        source = reliable(source)
    if check:
        check_vectors(source)
    stats = source.agg(F.count_if(has_nan("v")).alias("nan"), F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    alone = source.where(has_nan("v")).select("symbol", F.col("symbol").alias("canopy_id"), "v")
    left = stats["n"] - stats["nan"]
    if not left:
        return alone
    row_limit = max(1, batch_bytes // (stats["d"] * 8 + 64))
    undecided = source.where(~has_nan("v")) if stats["nan"] else source
    if left > min(batch, row_limit):  # more than one batch: written once in ranges of symbols
        undecided = reliable(undecided.repartitionByRange("symbol").withColumn("rng", F.spark_partition_id()))
    else:
        undecided = undecided.withColumn("rng", F.lit(0))
    root, size, step = scratch_path(spark, "canopy"), int(batch), 0

    def write(df: DataFrame) -> DataFrame:
        nonlocal step
        path, step = f"{root}/round={step}", step + 1
        df.withColumn("decided", F.col("canopy_id").isNotNull().cast("int")).write.partitionBy("decided").parquet(path)
        return spark.read.schema(_ROUND_SCHEMA).parquet(path)

    round_schema = f"{OUT_SCHEMA}, rng int"
    while left:
        take = min(size, row_limit)
        head = _head(undecided, take, left)
        decided = write(head.mapInArrow(greedy_pass(t1), round_schema))
        new = decided.where(F.col("symbol") == F.col("canopy_id"))
        centre_rows = sorted((r["symbol"], r["v"]) for r in new.select("symbol", "v").collect())  # at most a batch
        if left <= take:
            break
        last = decided.agg(F.max("symbol")).first()[0]
        ids = [sym for sym, _ in centre_rows]
        mat = np.asarray([cv for _, cv in centre_rows], dtype=np.float64)
        rest = undecided.where(F.col("symbol") > F.lit(last)).select("symbol", "v", "rng")
        undecided = write(rest.mapInArrow(label_with_centres(ids, mat, float(t1)), round_schema)).where(
            F.col("decided") == 0).select("symbol", "v", "rng")
        left = undecided.count()
        if len(centre_rows) * 2 > size:
            size = min(size * 2, int(max_batch))
    out = spark.read.schema(_ROUND_SCHEMA + ", round int").parquet(root).where(F.col("decided") == 1).select(
        "symbol", "canopy_id", "v")
    return out.unionByName(alone) if stats["nan"] else out


def _head(undecided: DataFrame, take: int, left: int) -> DataFrame:
    """The ``take`` smallest undecided symbols, read from the ranges that hold them."""
    if left > take:
        # one row per range; ranges are in symbol order
        counts = sorted(tuple(r) for r in undecided.groupBy("rng").agg(F.count(F.lit(1))).collect())
        seen = 0
        for last_range, n in counts:
            seen += n
            if seen >= take:
                break
        undecided = undecided.where(F.col("rng") <= F.lit(last_range))
    return undecided.select("symbol", "v", "rng").orderBy("symbol").limit(take)


def bucket_of(symbol_col, buckets: int):
    """Bucket = first 32 bits of md5(symbol) mod buckets (uniform; reproducible in plain SQL)."""
    h = F.conv(F.substring(F.md5(symbol_col), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(int(buckets))).cast("int")


def tree_levels(n: int, rows_per_bucket: int = 1_000_000, fan: int = 16) -> tuple[int, ...]:
    """Numbers of buckets of the levels, down to one: about ``rows_per_bucket`` vectors in each of the
    first level, then ``fan`` buckets of one level in one of the next."""
    levels = [max(1, -(-n // rows_per_bucket))]
    while levels[-1] > 1:
        levels.append(-(-levels[-1] // fan))
    return tuple(levels)


def canopy_tree(vectors: DataFrame, t1: float = 0.5, buckets: tuple[int, ...] | None = None, max_centres: int = 32768,
                batch: int = 2048, broadcast_bytes: int = 64 << 20, check: bool = True) -> DataFrame:
    """Greedy passes per hash bucket, then over the centres of several buckets, level by level -> (symbol, canopy_id, v).

    ``buckets`` holds the number of buckets of each level (``tree_levels`` of the count, where none are
    given).  A level sees only the centres that the one before left, and a single bucket is the exact
    distributed form.  No task holds more than ``max_centres`` centres at any level: a bucket
    with more takes several rounds.  Members follow their centre through all levels by one join with the composed mapping.
    With n levels a member lies within n * T1 of its canopy centre; vectors with NaN are their own canopies.
    """
    vectors = reliable(vectors.select("symbol", "v"))
    if check:
        check_vectors(vectors)
    alone = vectors.where(has_nan("v")).select("symbol", F.col("symbol").alias("canopy_id"), "v")
    level = vectors.where(~has_nan("v"))
    if buckets is None:
        buckets = tree_levels(level.count())
    passes = []
    for n in buckets:
        if n == 1:
            done = canopy(level, t1, min(batch, max_centres), max_centres, check=False, materialized=True)
        else:
            done = _bucket_pass(level, t1, int(n), max_centres)
        passes.append(done)
        level = done.where(F.col("symbol") == F.col("canopy_id")).select("symbol", "v")
    follow = None  # centre of a level -> the last centre it follows, from the top downwards
    for done in reversed(passes[1:]):
        step = done.select("symbol", "canopy_id")
        follow = reliable(step if follow is None else _followed(step, follow, broadcast_bytes))
    members = passes[0] if follow is None else reliable(_followed(passes[0], follow, broadcast_bytes))
    return members.select("symbol", "canopy_id", "v").unionByName(alone)


_LEVEL_SCHEMA = "symbol string, canopy_id string, v array<double>, bucket int, decided int"


def _bucket_pass(vectors: DataFrame, t1: float, buckets: int, max_centres: int) -> DataFrame:
    """One greedy pass per bucket, in rounds of at most ``max_centres`` centres a bucket -> (symbol, canopy_id, v)."""
    spark = vectors.sparkSession
    root, step = scratch_path(spark, "level"), 0
    left = vectors.select("symbol", "v", bucket_of(F.col("symbol"), buckets).alias("bucket"))
    while step == 0 or not left.isEmpty():
        passed = (
            left.repartitionByRange(buckets, "bucket")  # by range: hashing the few ids would put several into one task
            .sortWithinPartitions("bucket", "symbol")
            .mapInArrow(greedy_pass(t1, "bucket", max_centres), "symbol string, canopy_id string, v array<double>, bucket int")
        )
        path, step = f"{root}/round={step}", step + 1
        passed.withColumn("decided", F.col("canopy_id").isNotNull().cast("int")).write.partitionBy("decided").parquet(path)
        left = spark.read.schema(_LEVEL_SCHEMA).parquet(path).where(F.col("decided") == 0).select("symbol", "v", "bucket")
    return spark.read.schema(_LEVEL_SCHEMA + ", round int").parquet(root).where(F.col("decided") == 1).select(
        "symbol", "canopy_id", "v")


def _followed(rows: DataFrame, follow: DataFrame, broadcast_bytes: int) -> DataFrame:
    """``rows`` with their canopy_id replaced by the one that this centre follows."""
    mapping = follow.select(F.col("symbol").alias("local_id"), F.col("canopy_id").alias("final_id"))
    size = mapping.agg(F.sum(F.octet_length("local_id") + F.octet_length("final_id") + 48)).first()[0] or 0
    local = rows.withColumnRenamed("canopy_id", "local_id")
    if size <= broadcast_bytes:
        joined = local.join(F.broadcast(mapping), "local_id")
    else:  # a third of all rows may follow one centre
        from quiver.operators.joins import join_split_hot

        joined = join_split_hot(local, mapping, "local_id")
    return joined.withColumnRenamed("final_id", "canopy_id").drop("local_id")


def canopy_bucketed(vectors: DataFrame, t1: float = 0.5, buckets: int = 4, batch: int = 2048,
                    broadcast_rows: int = 1_000_000, check: bool = True) -> DataFrame:
    """Local greedy pass per hash bucket, then one merge of the local centres -> (symbol, canopy_id, v)."""
    levels = (buckets, 1) if buckets > 1 else (1,)
    return canopy_tree(vectors, t1, levels, batch=batch, broadcast_bytes=64 * broadcast_rows, check=check)


def canopy_sizes(members: DataFrame) -> DataFrame:
    """(canopy_id, n): members per canopy (partial aggregation)."""
    return members.groupBy("canopy_id").agg(F.count(F.lit(1)).cast("long").alias("n"))


def distance_to_centre(members: DataFrame, dim: int, broadcast_bytes: int = 64 << 20,
                       salts: int = 64) -> DataFrame:
    """(symbol, canopy_id, v) -> (symbol, canopy_id, dist): mean-L1 distance to the own canopy centre.

    The centre side has one row per canopy; it is broadcast under a size
    check, else salted, so a hot canopy never lands in one task.
    """
    from quiver.functions.distance import mean_l1
    from quiver.operators.joins import attach_by_canopy

    centres = members.where(F.col("symbol") == F.col("canopy_id")).select("canopy_id", F.col("v").alias("cv"))
    n_centres = centres.count()
    joined = attach_by_canopy(members, centres, n_centres * (dim * 8 + 48), broadcast_bytes, salts)
    return joined.select("symbol", "canopy_id", mean_l1(F.col("cv"), F.col("v")).alias("dist"))


def number_canopies(sizes: DataFrame) -> DataFrame:
    """Add ``canopy_no``: creation order of the canopy centres (= centre symbol order), 1-based."""
    from quiver.functions.ranking import global_row_number

    n = sizes.count()
    return global_row_number(sizes, [F.col("canopy_id")], "canopy_no", n_rows=n)
