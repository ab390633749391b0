"""Load report: which requested symbols have price data (semi / anti joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def loaded_symbols(requested: DataFrame, bars: DataFrame) -> DataFrame:
    return requested.select("symbol").distinct().join(bars.select("symbol"), "symbol", "left_semi")


def failed_symbols(requested: DataFrame, bars: DataFrame) -> DataFrame:
    return requested.select("symbol").distinct().join(bars.select("symbol"), "symbol", "left_anti")


def load_report(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """One row: requested, loaded and failed symbol counts."""
    have = bars.select("symbol").distinct().withColumn("has", F.lit(True))
    req = requested.select("symbol").distinct()
    tagged = req.join(have, "symbol", "left")
    return tagged.agg(
        F.count(F.lit(1)).cast("long").alias("requested"),
        F.count_if(F.col("has").isNotNull()).cast("long").alias("loaded"),
        F.count_if(F.col("has").isNull()).cast("long").alias("failed"),
    )
