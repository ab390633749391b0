"""Plan-shape checks for the properties the design relies on at scale."""

from pyspark.sql import functions as F

from quiver.operators import canopy as C
from quiver.operators import features as feat
from quiver.operators.kmeans import _round, assign, kmeans
from quiver.operators.results import number_clusters
from quiver.operators.seeding import seats, seeds
from quiver.plans.pipeline import select_symbols
from quiver.sources import customer_symbols, events_bars, load_table
from conftest import SF0001, vec_df


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_scan_reads_only_needed_columns(spark):
    p = plan(events_bars(load_table(spark, SF0001, "events")))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p
    assert "partial_min_by" in p  # map-side combine


def test_latest_days_limits_before_the_shuffle(spark):
    p = plan(feat.latest_days(events_bars(load_table(spark, SF0001, "events")), 5))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_requested_symbols_filter_below_aggregation(spark):
    bars = events_bars(load_table(spark, SF0001, "events"))
    req = customer_symbols(load_table(spark, SF0001, "customer"))
    p = plan(select_symbols(bars, req, 10))
    semi = p.index("LeftSemi")
    partial = p.index("partial_min_by")
    assert partial < semi  # printed top-down: the semi join sits under the partial aggregate


def test_seed_ranking_is_limited_before_the_shuffle(spark):
    v = vec_df(spark, [(f"s{i:02d}", [i / 40.0]) for i in range(40)])
    m = C.canopy(v, 0.3)
    st = seats(C.canopy_sizes(m), 6)
    p = plan(seeds(m, st))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_kmeans_join_broadcast_or_salted(spark):
    v = vec_df(spark, [(f"s{i:02d}", [i / 40.0]) for i in range(40)])
    m = C.canopy(v, 0.3)
    cent = seeds(m, seats(C.canopy_sizes(m), 6)).select("center_id", "canopy_id", "v")
    small = plan(assign(m, cent, 1, 6))
    assert "BroadcastHashJoin" in small
    salted = plan(_round(m, cent, None, 1, 6, broadcast_bytes=0, salts=4))
    assert "__salt" in salted and "hashpartitioning(canopy_id" in salted


def test_clusters_read_the_written_assignment(spark):
    v = vec_df(spark, [(f"s{i:02d}", [i / 40.0]) for i in range(40)])
    m = C.canopy(v, 0.3)
    cent = seeds(m, seats(C.canopy_sizes(m), 6)).select("center_id", "canopy_id", "v")
    res = kmeans(m, cent, 1)
    p = plan(number_clusters(res.assignments, res.n_centers))
    assert "MapInArrow" not in p and "MapInPandas" not in p  # the only Python pass wrote the table


def test_canopy_result_is_one_scan_of_all_rounds(spark):
    v = vec_df(spark, [(f"s{i:02d}", [i / 40.0]) for i in range(40)])
    p = plan(C.canopy(v, 0.01, batch=4, max_batch=4))
    assert p.count("FileScan") == 1 and "PartitionFilters" in p


def test_numbering_has_one_exchange(spark):
    from quiver.functions.ranking import global_row_number

    p = plan(global_row_number(spark.range(1000), [F.col("id")]))
    assert "hashpartitioning" not in p and "rangepartitioning" not in p  # the sort was written, offsets are broadcast
