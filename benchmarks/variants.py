"""Compare ways to run the same step, on ``BENCH_SF_DIR`` or on enlarged copies of its tables.

``python -m benchmarks.variants [factor]`` repeats orders, customers and events ``factor``
times with shifted user ids. A third of the repeated orders goes to one user.
"""

from __future__ import annotations

import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bench import median_seconds, session
from tagloom.functions.tags import merge_tags
from tagloom.operators import modal, profiles, scores
from tagloom.operators.match import match_equal
from tagloom.plans.jobs import ConsumptionCycleJob, match_jobs, statistics_jobs
from tagloom.plans.run import run_all, run_job
from tagloom.queries import catalog, standins
from tagloom.stores.hadoop import scratch_folder
from tagloom.stores.persona import SnapshotPersonaStore


RUNS = 3


def enlarged(frame: DataFrame, factor: int, key: str, hot: bool = False) -> DataFrame:
    if factor == 1:
        return frame
    copies = frame.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    moved = F.concat_ws("-", F.col(key).cast("string"), F.col("copy").cast("string"))
    if hot:
        moved = F.when(F.pmod(F.xxhash64("ordersn", "copy"), F.lit(3)) == 0, "hot").otherwise(moved)
    return copies.withColumn(key, moved).drop("copy")


def inputs(spark: SparkSession, sf_dir: str, factor: int) -> dict[str, DataFrame]:
    folder = scratch_folder(spark)
    tables = {
        "users": enlarged(standins.users(spark, sf_dir), factor, "id"),
        "orders": enlarged(standins.orders(spark, sf_dir), factor, "memberid", hot=True),
        "logs": enlarged(standins.logs(spark, sf_dir), factor, "global_user_id"),
    }
    for name, frame in tables.items():
        frame.repartition(16).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in tables}


def noop(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def match_by_dict_udf(users: DataFrame, values) -> DataFrame:
    ids = dict((rule, str(id_)) for id_, rule in values.rows)
    find = F.udf(lambda value: ids.get(str(value)), T.StringType())
    return users.select(F.col("id").cast("string").alias("userId"), find("job").alias("tagsId"))


@F.udf(T.StringType())
def merge_by_udf(new, old):
    if new is None or old is None:
        return new or old
    return ",".join(sorted(set(new.split(",")) | set(old.split(",")), key=int))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    factor = int(sys.argv[1]) if len(sys.argv) > 1 else 1
    spark = session()
    data = inputs(spark, sf_dir, factor)
    users, orders, logs = data["users"], data["orders"], data["logs"]
    segments = catalog.values(spark, 7)
    lists = users.select(
        F.concat(F.col("politicalface").cast("string"), F.lit(",5")).alias("new"),
        F.concat(F.col("gender").cast("string"), F.lit(",10,5")).alias("old"),
    )
    as_of = standins.ORDERS_AS_OF

    def separate_aggregates():
        noop(scores.rfm_features(orders, as_of))
        noop(scores.psm_features(orders))
        noop(ConsumptionCycleJob(as_of).profile(orders.select("memberid", "finishtime")))

    def read(_spark, spec):
        return data[spec.index].select(*spec.columns)

    rules = catalog.rule_book(spark)
    jobs = match_jobs() + statistics_jobs(as_of)

    def store() -> SnapshotPersonaStore:
        return SnapshotPersonaStore(spark, f"{scratch_folder(spark)}/persona")

    def one_upsert_per_job():
        target = store()
        for job in jobs:
            run_job(spark, job, rules, target, read)

    pairs = {
        "match_equal": {
            "python dict udf": lambda: noop(match_by_dict_udf(users, segments)),
            "broadcast join": lambda: noop(match_equal(users, F.col("job"), segments)),
        },
        "tags_merge": {
            "python udf": lambda: noop(lists.select(merge_by_udf("new", "old"))),
            "array functions": lambda: noop(lists.select(merge_tags(F.col("new"), F.col("old")))),
        },
        "payway_modal": {
            "window": lambda: noop(modal.modal_value_window(orders, "memberid", "paymentcode")),
            "two aggregates": lambda: noop(modal.modal_value(orders, "memberid", "paymentcode")),
        },
        "rfm + psm + cycle features": {
            "three aggregates": separate_aggregates,
            "one shared aggregate": lambda: noop(profiles.order_totals(orders)),
        },
        "rfe features": {"one aggregate": lambda: noop(profiles.log_profile(logs))},
        "persona update, 7 tags": {
            "merge and upsert per job": one_upsert_per_job,
            "one merge and upsert": lambda: run_all(spark, jobs, rules, store(), read),
        },
    }
    rows = {name: frame.count() for name, frame in data.items()}
    print(json.dumps({"rows": rows, "factor": factor}))
    for step, ways in pairs.items():
        times = {way: round(median_seconds(run, RUNS), 2) for way, run in ways.items()}
        print(json.dumps({step: times}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
