"""Result frames: cluster numbering, listing, sizes and per-day series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quiver.config import FEATURES
from quiver.functions.ranking import global_row_number

# Fixed value: largest centre count whose id -> number map is broadcast.
BROADCAST_CENTERS = 2_000_000


def number_clusters(assignments: DataFrame, n_centers: int | None = None) -> DataFrame:
    """(symbol, center_id, ...) -> (cluster_no, symbol); non-empty clusters numbered 1.. by center_id.

    ``n_centers`` (K, an upper bound on the distinct ids) lets the numbering
    use one small window.
    """
    used = assignments.select("center_id").distinct()
    numbered = global_row_number(used, [F.col("center_id")], "cluster_no", n_rows=n_centers)
    if n_centers is not None and n_centers <= BROADCAST_CENTERS:
        joined = assignments.join(F.broadcast(numbered), "center_id")  # K rows of two longs
    else:  # a centre holding a third of all vectors must not meet in one task
        from quiver.operators.joins import join_split_hot

        joined = join_split_hot(assignments.select("center_id", "symbol"), numbered, "center_id")
    return joined.select(
        F.col("cluster_no").cast("int").alias("cluster_no"), "symbol")


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_no").agg(F.count(F.lit(1)).cast("long").alias("n_symbols"))


def series(clusters: DataFrame, latest_raw: DataFrame, features=FEATURES) -> DataFrame:
    """Per-day mean of the chosen raw features for every clustered symbol.

    (cluster_no, symbol, day_index, value); day_index 1 = latest day.
    """
    total = None
    for f in features:
        total = F.col(f) if total is None else total + F.col(f)
    value = total / F.lit(float(len(features)))
    return clusters.join(latest_raw.select("symbol", "day_index", *features), "symbol").select(
        "cluster_no", "symbol", F.col("day_index").cast("int").alias("day_index"), value.alias("value"))


def series_min(series_df: DataFrame) -> DataFrame:
    return series_df.groupBy("symbol").agg(F.min("value").alias("min_value"))
