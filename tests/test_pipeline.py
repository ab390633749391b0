"""The full run through the pipeline API."""

from pyspark.sql import functions as F

from quiver.config import RunConfig
from quiver.plans.pipeline import run
from quiver.sources import customer_symbols, events_bars, load_table
from conftest import SF0001


def test_run_exact_and_bucketed(spark):
    bars = events_bars(load_table(spark, SF0001, "events"))
    syms = customer_symbols(load_table(spark, SF0001, "customer"))
    for cfg in (RunConfig(clusters=4), RunConfig(clusters=4, buckets=3), RunConfig(amount=10, clusters=2, days=3)):
        res = run(bars, cfg, syms)
        n = 10 if cfg.amount == 10 else 15
        cl = res.clusters.collect()
        assert len(cl) == n and len({r["symbol"] for r in cl}) == n
        assert max(r["cluster_no"] for r in cl) <= res.kmeans.n_centers
        assert res.series.count() == n * cfg.days
        # series values are the mean of the raw features of that day
        joined = res.series.join(res.clusters, ["cluster_no", "symbol"])
        assert joined.count() == n * cfg.days
        assert res.seats.agg(F.sum("seats")).first()[0] == res.kmeans.n_centers


def test_feature_subset_and_policies(spark):
    bars = events_bars(load_table(spark, SF0001, "events"))
    res = run(bars, RunConfig(clusters=3, features=("close",), degenerate="zero", days=4))
    v = res.vectors.first()["v"]
    assert len(v) == 4


def test_recent_first_run_equals_full_run(spark):
    import datetime as dt

    events = load_table(spark, SF0001, "events")
    bars = events_bars(events)
    syms = customer_symbols(load_table(spark, SF0001, "customer"))
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    cfg = RunConfig(clusters=4)
    full = run(bars, cfg, syms)
    fast = run(bars, cfg, syms, bars_since=lambda d: events_bars(events, d), since=last - dt.timedelta(days=9))
    assert sorted(full.clusters.collect()) == sorted(fast.clusters.collect())
    assert sorted(full.series.collect()) == sorted(fast.series.collect())
