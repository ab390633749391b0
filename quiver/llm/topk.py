"""Exact top-k inner products with block-at-a-time pruning.

Rows are cut into blocks of consecutive ids, each with a forward index (its quantised vectors) and the smallest
and largest value of every dimension. For a query the sum over the dimensions of the larger of
``q * min`` and ``q * max`` bounds every score in the block. Blocks are visited by falling bound and scored through
their forward index until the bound falls below the query's k-th score.

A part holds the blocks of one range of ids; the stated query set, in blocks, visits every part, and the parts' best
``k`` of each query are merged. The first part's k-th scores start the others (two rounds), so they prune early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import prepare, reliable

BLOCK = 256  # vectors in a block
PART = 8192  # vectors in a part, about
QUERIES = 256  # queries in a block
LEAST, MOST = -(2**63), 2**63 - 1  # of a long


def takes_part(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _matrix(raw: list[bytes]) -> np.ndarray:
    """Whole numbers; shorter vectors are filled with zeros."""
    own = [np.frombuffer(r, np.int64) for r in raw]
    out = np.zeros((len(own), max(map(len, own), default=0)), np.int64)
    for i, v in enumerate(own):
        out[i, : len(v)] = v
    return out


def _packed(key: str, size: int):
    """Rows ``(key, id, v)`` sorted by (key, id) to rows ``(key, ids, vs)`` of at most ``size`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vs = None, [], []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([vs], pa.list_(pa.binary()))], names=[key, "ids", "vs"])

        for b in batches:
            for k, i, v in zip(*(c.to_pylist() for c in b.columns)):
                if ids and (k != at or len(ids) >= size):
                    yield out()
                    ids, vs = [], []
                at = k
                ids.append(i)
                vs.append(np.array(v, np.int64).tobytes())
        if ids:
            yield out()

    return run


class Part:
    """The blocks of a part, with their bounds."""

    def __init__(self, blocks: list[tuple[list[int], list[bytes]]]):
        width = max((len(r) // 8 for _, vs in blocks for r in vs), default=0)
        self.ids = [np.array(ids, np.int64) for ids, _ in blocks]
        self.vectors = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (_matrix(vs) for _, vs in blocks)]
        self.low = np.stack([m.min(axis=0) for m in self.vectors]).astype(float)
        self.high = np.stack([m.max(axis=0) for m in self.vectors]).astype(float)
        self.doubles = [m.astype(float) for m in self.vectors]
        self.most = np.maximum(-self.low, self.high).max(axis=1, initial=0.0)

    def scores(self, b: int, q: np.ndarray) -> np.ndarray:
        """Exact inner products with a block: in doubles below 2 ** 52, as longs below 2 ** 62, else in whole numbers of any size,
        of which those beyond a long count as its nearest end."""
        qd = q.astype(float)
        reach = self.most[b] * np.abs(qd).sum()
        if reach < 2.0**52:
            return (self.doubles[b] @ qd).astype(np.int64)
        if reach < 2.0**62:
            return self.vectors[b] @ q
        exact = self.vectors[b].astype(object) @ q.astype(object)
        return np.array([min(max(x, LEAST), MOST) for x in exact], np.int64)

    def best(self, query: int, q: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """``(score, id)`` of the query's best ``k`` in the part that score at least ``floor``; also counts the blocks scored."""
        q = np.pad(q, (0, max(0, self.low.shape[1] - len(q))))[: self.low.shape[1]]
        low, high = self.low * q, self.high * q
        # doubles err by a few units in the last place for each dimension; the bound must not fall short
        bound = np.maximum(low, high).sum(axis=1) + (len(q) + 4) * 2.0**-51 * np.maximum(np.abs(low), np.abs(high)).sum(axis=1)
        floor = LEAST if floor is None else floor
        top: list[tuple[int, int]] = []
        self.scored = 0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] < floor and floor > LEAST:
                break
            self.scored += 1
            score = self.scores(b, q)
            own = (score >= floor) & (self.ids[b] != query)
            top += zip([-s for s in score[own].tolist()], self.ids[b][own].tolist())
            top = sorted(top)[:k]
            if len(top) == k:
                floor = max(floor, -top[-1][0])  # a block may still hold an equal score with a smaller id
        return [(-s, i) for s, i in top]


def _search(k: int):
    """Rows sorted by (part, role): the blocks of a part, then the blocks of queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks, part = None, [], None
        for b in batches:
            for key, role, ids, vs, floors in zip(*(c.to_pylist() for c in b.columns)):
                if key != at:
                    at, blocks, part = key, [], None
                if role == 0:
                    blocks.append((ids, vs))
                    continue
                if not blocks:
                    continue
                part = part or Part(blocks)
                out = [(q, s, i) for q, v, f in zip(ids, vs, floors)
                       for s, i in part.best(q, np.frombuffer(v, np.int64), k, f)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], names=["query_id", "score", "vec_id"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
          part_rows: int = PART) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query`` holds its ``k`` highest integer inner products
    among all rows but its own id; fewer if there are fewer, ties to the smaller id.

    Components are ``floor(scale * x)`` in double precision, those beyond a long being its nearest end; so are scores
    beyond it, which then tie. Products and sums are exact. Rows with a null id, null vectors and vectors with null or
    non-finite components take no part; missing components of shorter vectors count as zero, and an empty vector scores
    0. Of rows with one id each counts as a candidate; as a query an id counts once, with its smallest vector. Other
    columns are not read, whatever their names. No valid rows, or no queries: an empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    own = own.where(F.col("id").isNotNull() & takes_part(F.col("v"))).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long")))
    own = reliable(own, "vectors")
    n = own.count()
    parts = max(1, -(-n // part_rows))
    # ranges of ids: the parts are the range partitions, which are written with their number
    ranged = own.select("id", "v").repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id().cast("long"))
    blocks = reliable(ranged.select("part", "id", "v").sortWithinPartitions("part", "id").mapInArrow(_packed("part", BLOCK), "part long, ids array<long>, vs array<binary>"), "blocks")
    queries = own.where("q").groupBy("id").agg(F.min("v").alias("v"))
    asking = max(1, -(-queries.count() // QUERIES))
    queries = queries.select(F.pmod(F.xxhash64("id"), F.lit(asking)).cast("long").alias("block"), "id", "v").repartition("block").sortWithinPartitions("block", "id")
    queries = reliable(queries.mapInArrow(_packed("block", QUERIES), "block long, ids array<long>, vs array<binary>"), "queries")
    first = blocks.agg(F.min("part")).first()[0]

    def visit(which: Column, asked: DataFrame) -> DataFrame:
        held = blocks.where(which).select("part", F.lit(0).alias("role"), "ids", "vs", F.lit(None).cast("array<long>").alias("floors"))
        # the stated query set against the parts: a row for each block of queries and part
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
        sent = asked.withColumn("part", each).where(which).select("part", F.lit(1).alias("role"), "ids", "vs", "floors")
        dealt = held.union(sent).repartition("part").sortWithinPartitions("part", "role")
        return dealt.mapInArrow(_search(k), "query_id long, score long, vec_id long")

    if first is None:
        none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        return none
    unknown = queries.withColumn("floors", F.transform("ids", lambda x: F.lit(None).cast("long")))
    start = reliable(_best(visit(F.col("part") == first, unknown), k), "start")
    kth = start.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    asked = (queries.select("block", F.posexplode(F.arrays_zip("ids", "vs")).alias("at", "r")).select("block", "at", "r.ids", "r.vs")
             .join(kth, F.col("ids") == F.col("query_id"), "left").groupBy("block")
             .agg(F.array_sort(F.collect_list(F.struct("at", "ids", "vs", "floor"))).alias("r"))
             .select(F.col("r.ids").alias("ids"), F.col("r.vs").alias("vs"), F.col("r.floor").alias("floors")))
    rest = visit(F.col("part") != first, asked)
    best = _best(start.select("query_id", "score", "vec_id").union(rest), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
