"""Time the headline queries and print one JSON line.

Each query is written to the ``noop`` sink, so all its rows are computed and none are collected: one
warm-up, then the median of three runs. ``medallion_run`` writes every layer to a new folder.

BENCH_SF_DIR    folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS      local cores               (default 8)
BENCH_QUERIES   names, comma-separated    (default HEADLINE)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from strata.plans import catalog
from strata.plans.medallion import run_medallion
from strata.session import local_session, scratch_folder

HEADLINE = [
    "quality_ladder",
    "dedup_exact",
    "dedup_business_keys",
    "silver_trips",
    "gold_monthly",
    "gold_daily",
    "gold_hourly",
    "gold_month_focus",
    "gold_from_cells",
    "gold_monthly_all_trips",
    "report_monthly_revenue",
    "report_hourly_density",
    "sql_monthly_revenue",
    "sql_hourly_density",
    "travel_time_stats",
    "events_hourly_rollup",
    "orders_monthly_rollup",
    "baseline_all_orders",
    "late_arrivals",
    "schema_matrix",
    "schema_drift",
    "harmonized_union",
    "cast_losses",
    "cluster_roundtrip",
    "zorder_roundtrip",
    "medallion_run",
]


def medallion_run(spark, folder):
    files = catalog.landing_folder(spark, folder)
    layers = run_medallion(spark, files, scratch_folder(spark, "bench"), catalog.AS_CODED)
    return layers["report_monthly_revenue"]


def seconds(spark, folder, query) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    spark = local_session(cpus, "strata-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries() | {"medallion_run": medallion_run}

    timings = {}
    for name in names:
        seconds(spark, folder, queries[name])
        timings[name] = round(statistics.median(seconds(spark, folder, queries[name]) for _ in range(3)), 3)
        print(f"{name:32s} {timings[name]:8.3f}", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total of the median query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": folder.rsplit("sf", 1)[-1],
                "spark": spark.version,
                "cpus": int(cpus),
                "driver_memory": spark.conf.get("spark.driver.memory"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
