"""Benchmark the headline queries.

Runs each query to completion with the ``noop`` sink (the whole plan executes,
nothing is collected to the driver) on ``local[$BENCH_CPUS]`` against
``$BENCH_SF_DIR`` and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlake.plans import queries as Q  # noqa: E402
from barlake.session import build_session  # noqa: E402

HEADLINE = [
    "bars_daily",
    "clean_bars",
    "technical_stack",
    "cross_sectional_rank",
    "feature_matrix",
    "roc_auc",
    "class_metrics",
    "portfolio_stats",
    "upsert_bars",
    "upsert_instruments",
    "latest_predictions",
    "event_features",
    "run_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                          extra_conf={"spark.driver.memory": "16g"})
    # warm-up: JVM, parquet footers, codegen caches
    Q.QUERIES["bars_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
