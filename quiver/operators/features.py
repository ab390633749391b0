"""Feature pipeline: bars -> latest days -> min-max scaling -> one vector per symbol.

Window plans: every window is partitioned by ``symbol`` and the latest-days
filter is a ``row_number() <= D`` over it, which Spark plans as a partial
WindowGroupLimit before the shuffle, so a symbol with a very long history
ships at most D rows per map partition.  The min/max and count windows reuse
the same partitioning (no further exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quiver.config import FEATURES
from quiver.functions.scaling import minmax_scale
from quiver.operators.persist import reliable


def first_n_symbols(symbols: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` symbols by directory position (all when n is None)."""
    return symbols if n is None else symbols.where(F.col("pos") < F.lit(int(n)))


def latest_days(bars: DataFrame, days: int, features=FEATURES) -> DataFrame:
    """Keep the latest ``days`` bars per symbol; day_index 1 = latest (date descending, then the features)."""
    w = Window.partitionBy("symbol").orderBy(F.col("d").desc(), *features)
    return (
        bars.select("symbol", "d", *features)
        .withColumn("day_index", F.row_number().over(w))
        .where(F.col("day_index") <= F.lit(int(days)))
    )


def with_history_count(latest: DataFrame) -> DataFrame:
    return latest.withColumn("n_days", F.count(F.lit(1)).over(Window.partitionBy("symbol")))


def short_history(bars: DataFrame, days: int) -> DataFrame:
    """Symbols with fewer than ``days`` bars: (symbol, n_days)."""
    lat = latest_days(bars, days, ())
    return lat.groupBy("symbol").agg(F.count(F.lit(1)).cast("long").alias("n_days")).where(
        F.col("n_days") < F.lit(int(days)))


def full_history(bars: DataFrame, days: int, features=FEATURES, policy: str = "drop") -> DataFrame:
    """Latest-days rows of symbols that have all ``days`` bars.

    policy 'drop' removes short symbols (report them with :func:`short_history`);
    'raise' fails when any exists.
    """
    lat = with_history_count(latest_days(bars, days, features))
    if policy == "raise":
        short = lat.where(F.col("n_days") < days).select("symbol").limit(5).collect()
        if short:
            raise ValueError(f"symbols with fewer than {days} days, e.g. {[r[0] for r in short]}")
    return lat.where(F.col("n_days") == F.lit(int(days))).drop("n_days")


# Fixed value: short-symbol lists up to this many rows are broadcast.
BROADCAST_SHORT = 2_000_000


def latest_days_recent_first(bars_since, days: int, since, symbols: DataFrame | None = None,
                             features=FEATURES, universe: DataFrame | None = None) -> DataFrame:
    """Exact latest-D window that reads history only where the recent part falls short.

    ``bars_since(date_or_None)`` builds bars from the source, restricted to
    days >= the date when one is given (a pushed-down scan filter).  Symbols
    with D bars on or after ``since`` are complete: their latest D bars are all
    recent.  The others fall back to their full history through a semi join;
    they are ``symbols`` minus the complete ones when a requested list is
    given, else every symbol of the source (``universe``, a cheap listing of its
    symbols, spares building all bars for it) minus the complete ones.  Nothing
    older is read when every symbol is complete.
    Returns the latest-D rows of every symbol (short symbols keep their < D
    rows, exactly as :func:`latest_days` over the full source).
    """
    recent = with_history_count(latest_days(bars_since(since), days, features))
    complete = reliable(recent.where(F.col("n_days") == F.lit(int(days))).drop("n_days"))
    done = complete.select("symbol").distinct()
    if symbols is not None:
        universe = symbols
    elif universe is None:
        universe = bars_since(None)
    short = reliable(universe.select("symbol").distinct().join(done, "symbol", "left_anti"))
    n_short = short.count()
    if symbols is not None:
        complete = complete.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    if n_short == 0:
        return complete
    if n_short <= BROADCAST_SHORT:
        short = F.broadcast(short)  # the full history is then filtered without a shuffle
    older = latest_days(bars_since(None).join(short, "symbol", "left_semi"), days, features)
    return complete.unionByName(older.select(*complete.columns))


def feature_minmax(latest: DataFrame, features=FEATURES) -> DataFrame:
    """Min and max of each feature per symbol over the window."""
    aggs = []
    for f in features:
        aggs += [F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max")]
    return latest.groupBy("symbol").agg(*aggs)


def normalize(latest: DataFrame, features=FEATURES, lo: float = 0.0, hi: float = 1.0,
              degenerate: str = "nan") -> DataFrame:
    """Scale each feature per symbol into [lo, hi] over the window (same rows kept).

    degenerate 'drop' removes every symbol with a constant feature.
    """
    w = Window.partitionBy("symbol")
    cols = []
    const = F.lit(False)
    for f in features:
        mn, mx = F.min(f).over(w), F.max(f).over(w)
        cols.append(minmax_scale(F.col(f), mn, mx, lo, hi, degenerate).alias(f))
        const = const | (mn == mx)
    out = latest.select("symbol", "d", "day_index", *cols, const.alias("_const"))
    if degenerate == "drop":
        out = out.withColumn("_any_const", F.max(F.col("_const").cast("int")).over(w)).where(
            F.col("_any_const") == 0).drop("_any_const")
    return out.drop("_const")


def to_long(scaled: DataFrame, features=FEATURES) -> DataFrame:
    """Unpivot to (symbol, pos, x): pos = (day_index-1)*F + feature index, day-major, 0-based."""
    nf = len(features)
    arr = F.array(*[F.struct(F.lit(i).alias("fi"), F.col(f).alias("x")) for i, f in enumerate(features)])
    return scaled.select("symbol", "day_index", F.explode(arr).alias("e")).select(
        "symbol",
        ((F.col("day_index") - 1) * nf + F.col("e.fi")).cast("int").alias("pos"),
        F.col("e.x").alias("x"),
    )


def assemble(scaled: DataFrame, features=FEATURES) -> DataFrame:
    """One vector per symbol, day-major then feature order.

    Each group holds at most D rows (the window limit), so the ordered
    collect is bounded.
    """
    rows = F.sort_array(F.collect_list(F.struct("day_index", F.array(*features).alias("f"))))
    return scaled.groupBy("symbol").agg(F.flatten(F.transform(rows, lambda s: s["f"])).alias("v"))


def build_vectors(bars: DataFrame, days: int, features=FEATURES, degenerate: str = "nan",
                  short_policy: str = "drop") -> DataFrame:
    """bars -> (symbol, v array<double>) of length days * len(features)."""
    full = full_history(bars, days, features, short_policy)
    return assemble(normalize(full, features, degenerate=degenerate), features)


def equal_vector_groups(vectors: DataFrame, dim: int, hot: int | None = None,
                        broadcast_bytes: int = 64 << 20, salts: int = 64) -> DataFrame:
    """(symbol, v) -> (symbol, twin_of, n_same): the smallest symbol with an identical vector.

    Groups are found by a partial aggregation on the vector and joined back
    with :func:`joins.join_split_hot`, so a duplicated vector shared by a
    third of all symbols never sits in one task.
    """
    from quiver.operators.joins import HOT_KEY_ROWS, join_split_hot

    groups = reliable(vectors.groupBy("v").agg(F.min("symbol").alias("twin_of"),
                                               F.count(F.lit(1)).cast("long").alias("n_same")))
    out = join_split_hot(vectors.select("symbol", "v"), groups, "v", hot if hot is not None else HOT_KEY_ROWS,
                         broadcast_bytes, dim * 8 + 64, salts)
    return out.select("symbol", "twin_of", "n_same")
