"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and executed in full (noop write, nothing collected).
Before timing, every headline query runs once on the smallest scale
($BENCH_WARMUP_DIR, other data than the measured one) so JIT compilation,
codegen and Python worker start-up are not billed to the first queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quiver.plans.queries import QUERIES  # noqa: E402
from quiver.session import local_session  # noqa: E402

HEADLINE = ["bars", "lineitem_bars", "vectors_long", "latest_days_recent", "canopy_members", "canopy_members_bucketed", "nearest_neighbor", "seeds",
            "kmeans_3_iter", "clusters", "clusters_k40", "lineitem_clusters", "series", "embedding_canopy", "embedding_clusters"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="quiver-bench")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:  # warm-up, not reported
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "spark": spark.version}))


if __name__ == "__main__":
    main()
