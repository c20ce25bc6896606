"""Times the queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local
threads, BENCH_RUNS (default 3) the timed runs after one warm-up; the median is reported.
BENCH_QUERIES may list names, separated by commas.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from sensorloom.plans.registry import queries

HEADLINE = (
    "clean_measure",
    "clean_report",
    "error_counts",
    "enrich_measure",
    "validate_summary",
    "validate_duplicates",
    "json_decode",
    "recast",
    "doc_measurements",
    "doc_insert_ignore",
    "latest_snapshot",
    "historical_trend",
    "graph_vertices",
    "graph_edges",
    "graph_paths",
    "hot_spots",
    "daily_avg",
    "item_status_pretty",
    "bad_records",
    "stream_append",
    "stream_item_status",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sensorloom-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans = queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            plans[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
