"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated subset (default: HEADLINE)

Each query runs three times on one session into the noop sink, which evaluates
every row and column. ``first_run`` is the first time, ``queries`` the better of
the other two.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidemark.plans.registry import all_queries

HEADLINE = [
    "pickup_features",
    "pickup_features_preaggregated",
    "dropoff_features",
    "pit_lookup",
    "pit_lookup_bucketed",
    "training_set",
    "latest_snapshot",
    "change_feed",
    "feature_merge",
    "feature_incremental_refresh",
    "order_features_30d",
    "region_join",
    "training_matrix",
    "stream_pickup_features",
    "stream_pit_enrich",
    "pit_lookup_stored",
    "linear_score_batch",
    "score_batch",
    "fare_model_metrics",
    "pit_lookup_carry",
    "feature_merge_delta",
    "stream_features_delta",
    "incremental_load_manifest",
    "region_join_polygons",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds, first = {}, {}
    for name in names:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(round(time.perf_counter() - start, 3))
        first[name], seconds[name] = times[0], min(times[1:])
        print(f"{name}: first {first[name]}, then {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
