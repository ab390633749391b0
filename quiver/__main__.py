"""Command line (``spark-submit -m quiver ...`` or ``python -m quiver ...``).

  run      symbol directory + per-symbol price CSVs -> full pipeline -> outputs
  cluster  vector text (``SYM v1,v2,...``) -> canopies + k-means -> cluster text
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from quiver.config import FEATURES, RunConfig
from quiver.session import checkpoint_dir, release_scratch, scratch_mark, ship_package


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("quiver").getOrCreate()
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _run(args) -> dict:
    from quiver.operators.load import failed_symbols, load_report
    from quiver.operators.persist import reliable
    from quiver.plans.pipeline import run, write_run
    from quiver.sources import read_price_csv, read_symbol_directory
    from quiver.sources.files import number_directory

    spark = _session()
    mark = scratch_mark()
    cfg = RunConfig(amount=args.amount, days=args.days, clusters=args.clusters,
                    features=tuple(args.features.split(",")), t1=args.t1, seed=args.seed,
                    max_iter=args.max_iter, degenerate=args.degenerate, buckets=args.buckets)
    symbols = number_directory(read_symbol_directory(spark, args.symbols))
    bars = read_price_csv(spark, args.prices)
    res = run(bars, cfg, symbols, centers_path=f"{args.out.rstrip('/')}/centers_by_round")
    write_run(res, args.out)
    from quiver.operators.features import first_n_symbols

    requested = first_n_symbols(symbols, cfg.amount)
    loaded = reliable(bars.select("symbol").distinct())  # the price files are listed once for both reports
    report = reliable(load_report(requested, loaded))
    report.write.mode("overwrite").json(f"{args.out.rstrip('/')}/load_report")
    failed_symbols(requested, loaded).write.mode("overwrite").text(f"{args.out.rstrip('/')}/failed_symbols")
    out = {"rounds": res.kmeans.rounds, "converged": res.kmeans.converged, "centers": res.kmeans.n_centers, **report.first().asDict()}
    release_scratch(spark, mark)  # outputs are written; this run's intermediate tables are no longer read
    return out


def _cluster(args) -> dict:
    from quiver.operators.results import number_clusters
    from quiver.plans.pipeline import cluster_vectors
    from quiver.sinks import write_cluster_text
    from quiver.sources import read_vector_text

    spark = _session()
    mark = scratch_mark()
    cfg = RunConfig(clusters=args.clusters, t1=args.t1, seed=args.seed, max_iter=args.max_iter,
                    buckets=args.buckets)
    _, _, _, res = cluster_vectors(read_vector_text(spark, args.vectors), cfg)
    write_cluster_text(number_clusters(res.assignments, res.n_centers), args.out)
    release_scratch(spark, mark)
    return {"rounds": res.rounds, "converged": res.converged, "centers": res.n_centers}


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="quiver")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="symbol directory + price CSVs -> clusters, series")
    r.add_argument("--symbols", required=True)
    r.add_argument("--prices", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--amount", type=int, default=100)
    r.add_argument("--days", type=int, default=5)
    r.add_argument("--clusters", type=int, default=5)
    r.add_argument("--features", default=",".join(FEATURES))
    r.add_argument("--t1", type=float, default=0.4)
    r.add_argument("--degenerate", default="nan", choices=["nan", "zero", "drop"])
    c = sub.add_parser("cluster", help="vector text -> cluster text")
    c.add_argument("--vectors", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--clusters", type=int, default=5)
    c.add_argument("--t1", type=float, default=0.5)
    for sp in (r, c):
        sp.add_argument("--seed", default="42")
        sp.add_argument("--max-iter", dest="max_iter", type=int, default=None)
        sp.add_argument("--buckets", type=int, default=0)
    args = p.parse_args(argv)
    out = _run(args) if args.cmd == "run" else _cluster(args)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
