"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of the test tables and ``BENCH_CPUS`` the local core count.
Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Results
go to the no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tagloom.queries.catalog import QUERIES

HEADLINE = (
    "match_equal_segment",
    "match_range_string",
    "match_equal_many_rules",
    "match_range_many_rules",
    "tags_merge",
    "merge_new_with_store",
    "persona_merge_upsert",
    "persona_own_jobs",
    "consumption_cycle",
    "payway_modal",
    "payway_tags",
    "order_profile",
    "rfm_scores",
    "rfe_scores",
    "psm_score",
    "nearest_centre_fixed",
    "rfm_cluster_tags",
    "rfe_cluster_tags",
    "psm_cluster_tags",
    "persona_all_match_stat",
    "persona_all",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def median_seconds(run, runs: int) -> float:
    run()
    return statistics.median(seconds(run) for _ in range(runs))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session()
    times = {}
    for name in HEADLINE:

        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        times[name] = round(median_seconds(run, runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
