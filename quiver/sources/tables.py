"""Adapters from the parquet test tables to the pipeline's frames.

bars    (symbol string, d date, open, high, low, close double)
vectors (symbol string, v array<double>)
symbols (symbol string, pos long)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_bars(events: DataFrame, since=None) -> DataFrame:
    """Daily bars from an event stream: user = symbol, day of ts, first/max/min/last value.

    (user_id, ts) is unique, so first/last by ts are deterministic.  The
    aggregation is partial (map-side) so a hot symbol does not load one task.
    ``since`` (a date) keeps events from that day on, as a filter on the raw
    ``ts`` column that reaches the parquet scan.
    """
    if since is not None:
        events = events.where(F.col("ts") >= F.to_timestamp_ntz(F.lit(str(since))))
    return (
        events.where(F.col("value").isNotNull() & F.col("ts").isNotNull() & F.col("user_id").isNotNull())
        .groupBy(F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("d"))
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
        )
    )


def lineitem_bars(lineitem: DataFrame, since=None) -> DataFrame:
    """Second bar source: supplier x ship date over the extended price.

    Open/close are the prices of the first/last line of the day in
    (l_orderkey, l_linenumber) order, a total order within a day.  The pair is
    packed into one long (orderkey * 256 + linenumber; line numbers are 1..7 in
    this schema) so the aggregation stays a hash aggregation: a struct
    ordering key would force a sort-based one.  Out-of-range keys fail loudly.
    """
    if since is not None:
        lineitem = lineitem.where(F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit(str(since))))
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    fits = (ln >= 0) & (ln < 256) & (ok >= 0) & (ok < F.lit(1 << 55))
    order = F.when(fits, ok * 256 + ln).otherwise(
        F.raise_error(F.lit("lineitem order key out of the packable range")).cast("long"))
    return (
        lineitem.where(F.col("l_shipdate").isNotNull())
        .groupBy(F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("d"))
        .agg(
            F.min_by("l_extendedprice", order).alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max_by("l_extendedprice", order).alias("close"),
        )
    )


def embedding_vectors(embeddings: DataFrame) -> DataFrame:
    """Ready vectors: vec_id as the symbol, float embedding widened to double."""
    return embeddings.select(
        F.col("vec_id").cast("string").alias("symbol"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
    )


def customer_symbols(customer: DataFrame) -> DataFrame:
    """Requested symbols in directory order: customer key as symbol and as position."""
    return customer.select(F.col("c_custkey").cast("string").alias("symbol"), F.col("c_custkey").cast("long").alias("pos"))
