"""Joining a small per-canopy side (centres) to the large member side.

A canopy may hold a third of all vectors, so a plain shuffle join on
``canopy_id`` would put that third in one task.  The small side is broadcast
while its estimated size (known on the driver) is under ``broadcast_bytes``;
beyond that the members are spread over ``salts`` hash salts and each small
row is copied once per salt, so a hot canopy is split over ``salts`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quiver.operators.persist import reliable


def attach_by_canopy(members: DataFrame, side: DataFrame, est_bytes: int, broadcast_bytes: int = 64 << 20,
                     salts: int = 64) -> DataFrame:
    if est_bytes <= broadcast_bytes:
        return members.join(F.broadcast(side), "canopy_id")
    salted = members.withColumn("__salt", F.pmod(F.xxhash64("symbol"), F.lit(int(salts))).cast("int"))
    fanned = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1))))
    return salted.join(fanned, ["canopy_id", "__salt"]).drop("__salt")


# Fixed value: rows per key on the big side above which the key is "hot".
HOT_KEY_ROWS = 10_000


def join_split_hot(big: DataFrame, small: DataFrame, key: str, hot: int = HOT_KEY_ROWS,
                   broadcast_bytes: int = 64 << 20, small_row_bytes: int = 64, salts: int = 64) -> DataFrame:
    """Inner join ``big`` with ``small`` (unique ``key``) so no key's rows meet in one task.

    Keys holding more than ``hot`` big-side rows are found by a partial
    aggregation (there are at most N / hot of them).  Their small rows are
    broadcast while they fit ``broadcast_bytes`` (estimated with
    ``small_row_bytes`` per row), else joined on (key, salt) with each small
    row copied once per salt.  Hot rows are split off before the remaining
    (cold) rows go through an ordinary shuffle join.
    """
    hot_keys = big.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > F.lit(int(hot)))
    hot_small = small.join(hot_keys.select(key), key, "left_semi")
    n_hot = hot_small.count()
    if n_hot == 0:
        return big.join(small, key)
    if n_hot * small_row_bytes <= broadcast_bytes:
        flagged = big.join(F.broadcast(hot_small.select(key, F.lit(True).alias("__hot"))), key, "left")
        hot_part = flagged.where(F.col("__hot").isNotNull()).drop("__hot").join(F.broadcast(hot_small), key)
        cold = flagged.where(F.col("__hot").isNull()).drop("__hot")
    else:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(int(salts))).cast("int")
        fanned = hot_small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1)))) \
            .withColumn("__hot", F.lit(True))
        tagged = big.withColumn("__salt", salt).join(fanned, [key, "__salt"], "left").drop("__salt")
        hot_part = tagged.where(F.col("__hot").isNotNull()).drop("__hot")
        cold = tagged.where(F.col("__hot").isNull()).select(*big.columns)
    cold_small = small.join(hot_small.select(key), key, "left_anti")
    cols = hot_part.columns
    return hot_part.unionByName(cold.join(cold_small, key).select(*cols))


def salt_by_count(rows: DataFrame, key: str, rows_per_salt: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``__salt``, and (key, __s): a key of n rows gets ceil(n / rows_per_salt) salts by symbol."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    salts = reliable(sizes.select(key, F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(int(rows_per_salt)))).cast("int").alias("__s")))
    salted = join_split_hot(rows, salts, key, small_row_bytes=32)
    return salted.withColumn("__salt", F.pmod(F.xxhash64("symbol"), F.col("__s")).cast("int")).drop("__s"), salts
