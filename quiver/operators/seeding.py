"""Seat allocation over canopies and deterministic seed selection.

Seats (all-integer, one per canopy at least):
  N vectors, C canopies, K = min(N, max(k, C));
  k_i = 1 + ((K-C)(n_i-1)) div (N-C) + [rank(remainder desc, canopy_id) <= leftover]
  leftover = K - sum of the first two terms; when N = C every k_i = 1.
This gives sum k_i = K and 1 <= k_i <= n_i.

Seeds: inside each canopy, members ordered by md5(seed || ':' || symbol);
the first k_i become centres.  center_id numbers the seeds 1..K in
(canopy_id, seed rank) order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quiver.functions.ranking import global_row_number


def seats(sizes: DataFrame, k: int) -> DataFrame:
    """(canopy_id, n) -> (canopy_id, n, seats).  Only scalars reach the driver."""
    tot = sizes.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("C")).first()
    n_total, n_canopies = int(tot["N"] or 0), int(tot["C"] or 0)
    if n_canopies == 0:
        return sizes.withColumn("seats", F.lit(0).cast("long"))
    kk = min(n_total, max(int(k), n_canopies))
    if n_total == n_canopies:
        return sizes.select("canopy_id", "n", F.lit(1).cast("long").alias("seats"))
    factor, denom = kk - n_canopies, n_total - n_canopies
    # exact integer arithmetic (ANSI mode raises rather than wraps on overflow)
    share = f"(cast({factor} as bigint) * (cast(n as bigint) - 1))"
    based = sizes.select(
        "canopy_id", "n",
        F.expr(f"1 + {share} div {denom}").alias("base"),
        F.expr(f"{share} % {denom}").alias("rem"),
    )
    leftover = kk - int(based.agg(F.sum("base")).first()[0])
    if leftover <= 0:
        return based.select("canopy_id", "n", F.col("base").alias("seats"))
    ranked = global_row_number(based, [F.col("rem").desc(), F.col("canopy_id").asc()], "r", n_rows=n_canopies)
    extra = F.when(F.col("r") <= F.lit(leftover), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return ranked.select("canopy_id", "n", (F.col("base") + extra).alias("seats"))


def seeds(members: DataFrame, seat_table: DataFrame, seed: str = "42", rows_per_group: int = 1_000_000) -> DataFrame:
    """Pick seats[canopy] members per canopy -> (center_id, canopy_id, symbol, v).

    The ranking is limited by the largest seat count, a literal, so Spark applies
    a partial top-k before each shuffle.  With canopies over ``rows_per_group``
    members it has two levels: first within salted parts of a canopy, then over
    the parts' first rows, so no task ranks a hot canopy whole.
    """
    agg = seat_table.agg(F.max("seats").alias("kmax"), F.sum("seats").alias("k"), F.max("n").alias("n")).first()
    kmax, total = int(agg["kmax"] or 0), int(agg["k"] or 0)
    parts = -(-int(agg["n"] or 0) // int(rows_per_group))
    order = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col("symbol")))
    top = members
    if parts > 1:
        top = _first(top.withColumn("__p", F.pmod(F.xxhash64("symbol"), F.lit(parts))), ["canopy_id", "__p"], order, kmax).drop("r", "__p")
    top = _first(top, ["canopy_id"], order, kmax)
    chosen = top.join(seat_table.select("canopy_id", "seats"), "canopy_id").where(F.col("r") <= F.col("seats"))
    numbered = global_row_number(chosen.select("canopy_id", "r", "symbol", "v"),
                                 [F.col("canopy_id"), F.col("r")], "center_id", n_rows=total)
    return numbered.select("center_id", "canopy_id", "symbol", "v")


def _first(rows: DataFrame, keys: list[str], order: Column, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order, F.col("symbol"))
    return rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= F.lit(k))
