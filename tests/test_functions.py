import math

import numpy as np
from pyspark.sql import functions as F

from quiver.functions.distance import mean_l1
from quiver.functions.ranking import global_row_number
from quiver.functions.scaling import minmax_scale
from conftest import vec_df


def test_mean_l1_matches_sequential_sum(spark):
    rng = np.random.default_rng(1)
    a, b = rng.random(20), rng.random(20)
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<double>, b array<double>")
    got = df.select(mean_l1("a", "b").alias("d")).first()["d"]
    acc = 0.0
    for x, y in zip(a, b):
        acc += abs(x - y)
    assert got == acc / 20


def test_minmax_scale_constant_feature(spark):
    df = spark.createDataFrame([(3.0, 3.0, 3.0), (2.0, 1.0, 5.0)], "x double, mn double, mx double")
    nan = [r[0] for r in df.select(minmax_scale(F.col("x"), F.col("mn"), F.col("mx"))).collect()]
    zero = [r[0] for r in df.select(minmax_scale(F.col("x"), F.col("mn"), F.col("mx"), degenerate="zero")).collect()]
    assert math.isnan(nan[0]) and nan[1] == 0.25
    assert zero == [0.0, 0.25]


def test_minmax_scale_adds_lower_bound(spark):
    df = spark.createDataFrame([(2.0, 1.0, 5.0)], "x double, mn double, mx double")
    assert df.select(minmax_scale(F.col("x"), F.col("mn"), F.col("mx"), lo=-1.0, hi=1.0)).first()[0] == -0.5


def test_global_row_number_is_exact(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 50, 5000).tolist()
    df = spark.createDataFrame([(int(k), i) for i, k in enumerate(keys)], "k long, i long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = df.orderBy("k", "i").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1  # the offsets really matter
        got = global_row_number(df, [F.col("k"), F.col("i")], "rn").orderBy("rn").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expect = sorted((k, i) for i, k in enumerate(keys))
    assert [(r["k"], r["i"]) for r in got] == expect
    assert [r["rn"] for r in got] == list(range(1, 5001))
    small = global_row_number(df, [F.col("k"), F.col("i")], "rn", n_rows=5000).orderBy("rn").collect()
    assert [(r["k"], r["i"], r["rn"]) for r in small] == [(r["k"], r["i"], r["rn"]) for r in got]


def test_vector_equality_groups(spark):
    from quiver.operators.features import equal_vector_groups

    rows = [("a", [1, 2]), ("b", [1, 2]), ("c", [2, 1])] + [(f"h{i:02d}", [5, 5]) for i in range(30)]
    v = vec_df(spark, rows)
    expect = {"a": ("a", 2), "b": ("a", 2), "c": ("c", 1), **{f"h{i:02d}": ("h00", 30) for i in range(30)}}
    for kw in ({"hot": 10_000}, {"hot": 5}, {"hot": 5, "broadcast_bytes": 0, "salts": 4}):
        got = {r["symbol"]: (r["twin_of"], r["n_same"]) for r in equal_vector_groups(v, 2, **kw).collect()}
        assert got == expect
