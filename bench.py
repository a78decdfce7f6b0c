"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR   folder of tables    (default /root/testdata/sf0.1)
BENCH_CPUS     local cores         (default 8)
BENCH_QUERIES  comma-separated names, or "all"

Each query is planned and run to the end twice, without collecting its rows.
``queries`` holds the second run, ``cold`` the first.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from registry.queries import QUERIES

HEADLINE = [
    "clean_events",
    "validate_counts",
    "user_features",
    "trailing_counts",
    "event_features",
    "user_segments",
    "summary_activity",
    "query_topn",
    "query_range",
    "feature_upsert",
    "cells_encode",
    "query_cells",
    "profile_describe",
    "activity_levels",
    "dist_buy_ratio",
    "ecdf_buy_ratio",
    "crosstab_days_items",
    "box_by_activity",
    "kde_by_group",
    "ingest_buckets",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    names = list(QUERIES) if chosen == "all" else chosen.split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(name):
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    cold = {name: timed(name) for name in names}
    warm = {name: timed(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
