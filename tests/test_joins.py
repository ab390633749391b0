from pyspark.sql import Window, functions as F

from quiver.operators.canopy import canopy, canopy_bucketed
from quiver.operators.joins import join_split_hot
from quiver.operators.results import number_clusters
from conftest import vec_df


def test_join_split_hot_matches_plain_join(spark):
    big = spark.createDataFrame([(i, "h" if i % 3 else f"k{i % 7}") for i in range(300)], "id long, key string")
    small = spark.createDataFrame([("h", 1)] + [(f"k{i}", i + 10) for i in range(7)], "key string, val long")
    expect = sorted(big.join(small, "key").select("id", "key", "val").collect())
    for kw in ({"hot": 1000}, {"hot": 50}, {"hot": 50, "broadcast_bytes": 0, "salts": 5}):
        got = sorted(join_split_hot(big, small, "key", **kw).select("id", "key", "val").collect())
        assert got == expect


def test_hot_paths_of_bucketed_canopy_and_numbering(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    v = vec_df(spark, [(f"z{i:03d}", rng.random(3).tolist()) for i in range(90)])
    a = sorted(canopy_bucketed(v, 0.3, buckets=3).collect())
    b = sorted(canopy_bucketed(v, 0.3, buckets=3, broadcast_rows=0).collect())
    assert a == b
    asg = canopy(v, 0.3).select(
        "symbol", F.dense_rank().over(Window.orderBy("canopy_id")).cast("long").alias("center_id"))
    x = sorted(number_clusters(asg, 100).collect())
    y = sorted(number_clusters(asg, None).collect())
    assert x == y
