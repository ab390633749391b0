"""Exact global row numbers without funnelling rows into one task.

``row_number() over (order by ...)`` with no partition moves every row to a
single task.  Here the rows are range-partitioned by a distributed sort and keep
their place inside the sorted partition; per-partition offsets (one row per
partition, bounded by the partition count) shift them to global positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quiver.operators.persist import reliable


# Fixed value: row count up to which one ordered window (one task) is used.
SMALL_ROWS = 100_000


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      n_rows: int | None = None) -> DataFrame:
    """Append a 1-based global ``name`` column in the given total order.

    The order must be total (include a unique tie-breaker) for the result to
    be deterministic.  When the caller knows the frame has at most
    ``SMALL_ROWS`` rows (``n_rows``, e.g. K centres or C canopies) a single
    ordered window is used; otherwise the distributed form below.
    """
    if n_rows is not None and n_rows <= SMALL_ROWS:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    # after the sort a row's id is (partition, place in the partition): one exchange numbers everything
    sorted_df = reliable(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    pid = F.shiftright("__id", 33).cast("int")
    counts = sorted_df.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n")).collect()
    offsets, running = [], 0
    for row in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((row["__pid"], running))
        running += row["__n"]
    off_df = df.sparkSession.createDataFrame(offsets, "__pid int, __off long")
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        sorted_df.withColumn("__pid", pid)
        .join(F.broadcast(off_df), "__pid")  # one row per partition
        .withColumn(name, (F.col("__off") + place).cast("long"))
        .drop("__pid", "__id", "__off")
    )
