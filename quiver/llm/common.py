"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.operators.persist import reliable
from quiver.session import checkpoint_dir, scratch_path, ship_package


def prepare(spark: SparkSession) -> None:
    """Read the shared checkpoint folder of the session and ship the package to the workers."""
    checkpoint_dir(spark)
    ship_package(spark)


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected components of the edges (a, b): each node but the roots, with its smallest node."""
    if not len(a):
        return a, b
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` (long ids): rows ``(node, root)``, the root being the
    smallest id of its component, for every node that has an edge.

    Alternating large-star / small-star rounds. A round takes the smallest neighbour of every node
    by a partial aggregation, so a hub's edges are never gathered in one task, and joins it back; each
    round is written to the shared folder, so lost executors cost a re-read. Logarithmically many rounds.
    """
    spark = edges.sparkSession

    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("m"))

    cur = reliable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = smallest(large)
        cur = reliable(large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct(), name)
    stars = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(cur.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root")))


def bucketed(df: DataFrame, buckets: int, key: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder bucketed by ``key``; a later join on ``key`` does not shuffle it."""
    spark = df.sparkSession
    table = f"quiver_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(buckets, key).option("path", scratch_path(spark, name)).option("compression", "none")
       .format("parquet").saveAsTable(table))
    return spark.table(table)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
