"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed to completion with the ``noop`` sink (nothing is collected to the
driver), three times on a warm session; the per-query figure is the median.  The headline
set walks the whole tiered path: ingest validation → refined tables → aggregates → reports.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "stream_ingest_events",
    "stream_ingest_orders",
    "ingest_dead_letter",
    "clean_events",
    "validate_orders",
    "daily_kpis",
    "customer_360",
    "report_dau",
    "report_top_products",
    "report_user_segments",
    "report_funnel",
    "report_anomaly_events",
    "source_freshness",
    "silver_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE

    from tierline.plans.catalog import QUERIES
    from tierline.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="tierline-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings = {}
    for name in names:
        run(name)  # untimed: compiles the query's code and lists its files
        timings[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
