import datetime as dt
import math

import pytest

from quiver.operators import features as feat


def bars_df(spark, rows):
    return spark.createDataFrame(rows, "symbol string, d date, open double, high double, low double, close double")


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def test_latest_days_newest_first_and_short_history(spark):
    rows = [("A", day(i), float(i), i + 1.0, i - 1.0, i + 0.5) for i in range(6)]
    rows += [("B", day(i), 1.0, 2.0, 0.5, 1.5) for i in range(2)]  # fewer rows than the window
    bars = bars_df(spark, rows)
    lat = feat.latest_days(bars, 3).where("symbol = 'A'").orderBy("day_index").collect()
    assert [r["d"] for r in lat] == [day(5), day(4), day(3)]
    assert {r["symbol"]: r["n_days"] for r in feat.short_history(bars, 3).collect()} == {"B": 2}
    full = feat.full_history(bars, 3)
    assert {r["symbol"] for r in full.collect()} == {"A"}
    with pytest.raises(ValueError):
        feat.full_history(bars, 3, policy="raise")


def test_vector_layout_is_day_major(spark):
    rows = [("A", day(0), 0.0, 10.0, 0.0, 5.0), ("A", day(1), 2.0, 20.0, 4.0, 10.0)]
    vec = feat.build_vectors(bars_df(spark, rows), 2).first()
    # day 1 = latest (day(1)): all features at their max -> 1; day 2: all at min -> 0
    assert vec["v"] == [1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0]


def test_one_day_window_is_constant(spark):
    bars = bars_df(spark, [("A", day(0), 1.0, 2.0, 0.5, 1.5)])
    nan_vec = feat.build_vectors(bars, 1).first()["v"]
    assert all(math.isnan(x) for x in nan_vec)
    assert feat.build_vectors(bars, 1, degenerate="zero").first()["v"] == [0.0] * 4
    assert feat.build_vectors(bars, 1, degenerate="drop").count() == 0


def test_feature_subset_keeps_fixed_order(spark):
    rows = [("A", day(0), 0.0, 10.0, 0.0, 5.0), ("A", day(1), 2.0, 20.0, 4.0, 10.0)]
    vec = feat.build_vectors(bars_df(spark, rows), 2, features=("close", "open")).first()["v"]
    assert len(vec) == 4


def test_first_n_symbols_uses_position(spark):
    syms = spark.createDataFrame([("Z", 0), ("A", 1), ("M", 2)], "symbol string, pos long")
    assert [r["symbol"] for r in feat.first_n_symbols(syms, 2).orderBy("pos").collect()] == ["Z", "A"]


def test_recent_first_window_is_exact(spark):
    from pyspark.sql import functions as F

    rows = []
    for i in range(10):  # A: trades every day
        rows.append(("A", day(i), float(i), i + 1.0, i - 1.0, i + 0.5))
    for i in (0, 1, 2, 8, 9):  # B: only 2 recent days -> needs history
        rows.append(("B", day(i), 1.0 + i, 2.0 + i, 0.5, 1.5))
    for i in (0, 1, 2, 3, 4, 5):  # C: nothing recent
        rows.append(("C", day(i), 3.0, 4.0 + i, 2.0, 3.5))
    bars = bars_df(spark, rows)

    def since_fn(d):
        return bars if d is None else bars.where(F.col("d") >= F.lit(d))

    key = ["symbol", "d", "day_index", "open", "high", "low", "close"]
    expect = sorted(feat.latest_days(bars, 4).select(*key).collect())
    got = sorted(feat.latest_days_recent_first(since_fn, 4, day(6)).select(*key).collect())
    assert got == expect
    req = spark.createDataFrame([("A",), ("C",), ("Z",)], "symbol string")
    got_req = sorted(feat.latest_days_recent_first(since_fn, 4, day(6), req).select(*key).collect())
    assert got_req == [r for r in expect if r["symbol"] in ("A", "C")]
