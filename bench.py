"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8). Each query is run once to
warm up and then timed, its whole result written to the noop sink."""

from __future__ import annotations

import json
import os
import time

HEADLINES = (
    "covered_norm_stats",
    "temporal_audit",
    "timestamp_gap_intervals",
    "split_windows",
    "window_index",
    "signal_dim_metrics",
    "lag_alignment",
    "asof_nearest",
    "interval_coalesce",
    "compact_ranges",
    "camera_slots",
    "vector_dim_stats",
    "quality_admission",
    "dedupe_first_wins",
    "status_rollup",
    "leaderboard",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from kinetrail.plans import catalog

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
