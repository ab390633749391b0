"""End-to-end runs through the command line on files derived from the test tables."""

from pyspark.sql import functions as F

from quiver.__main__ import main
from quiver.session import scratch_path
from quiver.sinks import write_price_csv, write_symbol_directory, write_vector_text
from quiver.sources import customer_symbols, events_bars, load_table, read_assignments, read_cluster_text
from quiver.operators.features import build_vectors
from conftest import SF0001


def test_run_from_directory_and_price_files(spark):
    syms = customer_symbols(load_table(spark, SF0001, "customer"))
    bars = events_bars(load_table(spark, SF0001, "events"))
    sym_dir, px_dir, out = scratch_path(spark, "c-sym"), scratch_path(spark, "c-px"), scratch_path(spark, "c-out")
    write_symbol_directory(syms, sym_dir)
    write_price_csv(bars, px_dir)
    res = main(["run", "--symbols", sym_dir, "--prices", px_dir, "--out", out, "--amount", "20", "--clusters", "3"])
    assert res["requested"] == 20 and res["loaded"] == 15 and res["failed"] == 5
    cl = read_cluster_text(spark, f"{out}/clusters")
    assert cl.count() == 15
    assert spark.read.parquet(f"{out}/series").count() == 15 * 5
    assert spark.read.parquet(f"{out}/centers_by_round").select("iter").distinct().count() == res["rounds"]
    assert spark.read.text(f"{out}/failed_symbols").count() == 5
    a = read_assignments(spark, f"{out}/assignments")
    assert a.count() == 15 and a.select("center_id").distinct().count() <= res["centers"]


def test_cluster_from_vector_text(spark):
    vec = build_vectors(events_bars(load_table(spark, SF0001, "events")), 5)
    vdir, out = scratch_path(spark, "c-vec"), scratch_path(spark, "c-cl")
    write_vector_text(vec, vdir)
    from quiver.session import _SCRATCH

    before = list(_SCRATCH)
    res = main(["cluster", "--vectors", vdir, "--out", out, "--clusters", "4"])
    assert _SCRATCH == before  # the run's own intermediate tables were released
    cl = read_cluster_text(spark, out)
    assert cl.count() == 15
    assert cl.select(F.max("cluster_no")).first()[0] <= res["centers"]
