import __spark_entry__ as E
from conftest import SF0001

ROWS_ONLY: set = set()


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["cluster_no", "symbol"]
    assert len(rows) == 15
    assert len({r["symbol"] for r in rows}) == 15


def test_every_query_has_an_oracle_unless_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E.QUERIES) - set(o) <= ROWS_ONLY


def test_small_queries_run(spark):
    q = E.queries()
    for name in ("bars", "latest_days", "vectors_long", "canopy_members", "load_report"):
        assert q[name](spark, SF0001).count() > 0
