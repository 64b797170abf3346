from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagloom.plans import compute_all, compute_job, match_jobs, mining_jobs, run_all, run_job, statistics_jobs, tag_counts
from tagloom.plans.jobs import AttributeJob, PsmJob, RfmJob, TagJob
from tagloom.queries import standins
from tagloom.queries.catalog import rule_book, standin_reader
from tagloom.sources import RuleBook, TagValues
from tagloom.stores import ModelStore, SnapshotPersonaStore

SF_DIR = "/root/testdata/sf0.001"


class EveryoneJob(TagJob):
    """A tag of our own: everyone gets the first value."""

    level4_id = 65

    def compute(self, business, values):
        return business.select(F.col("id").alias("userId"), F.lit(values.rows[0][0]).alias("tagsId"))


class PrintingJob(TagJob):
    level4_id = 65

    def compute(self, business, values):
        business.count()


def content(store):
    return dict(map(tuple, store.read_tags_id().collect()))


def test_own_job(spark, tmp_path):
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    run_job(spark, EveryoneJob(), rule_book(spark), store, standin_reader(SF_DIR))
    tags = content(store)
    assert len(tags) == 150 and set(tags.values()) == {"66"}


def test_job_must_return_a_frame(spark):
    with pytest.raises(TypeError, match="NoneType"):
        compute_job(spark, PrintingJob(), rule_book(spark), standin_reader(SF_DIR))


def test_run_all_equals_one_job_at_a_time(spark, tmp_path):
    models = ModelStore(spark, str(tmp_path / "models"))
    jobs = match_jobs() + statistics_jobs(standins.ORDERS_AS_OF) + [EveryoneJob()]
    jobs += mining_jobs(models, standins.ORDERS_AS_OF, standins.EVENTS_AS_OF)
    stores = [SnapshotPersonaStore(spark, str(tmp_path / name)) for name in ("a", "b")]
    old = spark.createDataFrame([("3", "900,1"), ("none", "2")], "userId string, tagsId string")
    for store in stores:
        store.upsert(old)
    run_all(spark, jobs, rule_book(spark), stores[0], standin_reader(SF_DIR))
    for job in jobs:
        run_job(spark, job, rule_book(spark), stores[1], standin_reader(SF_DIR))
    together = content(stores[0])
    assert together == content(stores[1])
    assert together["none"] == "2" and "900" in together["3"].split(",")
    # A rerun changes nothing.
    run_all(spark, jobs, rule_book(spark), stores[0], standin_reader(SF_DIR))
    assert content(stores[0]) == together
    counts = dict(map(tuple, tag_counts(stores[0].read()).collect()))
    assert counts["66"] == 150 and sum(counts.values()) == sum(len(t.split(",")) for t in together.values())


def test_tag_order_follows_centre_value(spark, tmp_path):
    models = ModelStore(spark, str(tmp_path))
    job = PsmJob(models)
    orders = standins.orders(spark, SF_DIR)
    values = TagValues.local(spark, [(51 + i, "") for i in range(5)])
    tagged = job.compute(orders, values)
    scored = job.score(job.profile(orders)).select("userId", "psm")
    means = tagged.join(scored, "userId").groupBy("tagsId").agg(F.avg("psm").alias("m")).orderBy("tagsId").collect()
    assert [r["m"] for r in means] == sorted((r["m"] for r in means), reverse=True)
    assert tagged.count() == scored.filter("psm is not null").count()


def test_unscored_members_are_dropped_and_untagged_clusters_kept(spark, tmp_path):
    orders = spark.createDataFrame(
        [("1", "a", 100.0, 10.0, 0), ("2", "b", 100.0, 90.0, 0), ("3", "c", 100.0, None, 0)],
        "memberid string, ordersn string, orderamount double, couponcodevalue double, finishtime bigint",
    )
    job = PsmJob(ModelStore(spark, str(tmp_path)), k=2)
    tagged = job.compute(orders, TagValues.local(spark, [(51, "only")]))
    assert {r["userId"]: r["tagsId"] for r in tagged.collect()} == {"1": None, "2": "51"}


def test_saved_model_gives_the_same_tags(spark, tmp_path):
    def tags():
        job = RfmJob(ModelStore(spark, str(tmp_path)), standins.ORDERS_AS_OF)
        rows = compute_job(spark, job, rule_book(spark), standin_reader(SF_DIR)).collect()
        return sorted(map(tuple, rows))

    assert tags() == tags()


def test_hot_user_and_duplicate_rows(spark, tmp_path):
    """A third of all user rows share one id; tags are united, not lost or repeated."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 2 == 0, "1").otherwise("2").alias("gender"),
    )
    rules = RuleBook(
        spark.createDataFrame([(4, 1, "inType=es##esIndex=u"), (5, 4, "1"), (6, 4, "2")], "id int, pid int, rule string")
    )
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    run_all(spark, [AttributeJob(4, "gender")], rules, store, lambda _spark, _spec: rows)
    tags = content(store)
    assert len(tags) == 2001 and tags["0"] == "5,6" and tags["1"] == "6"


def test_no_python_in_job_plans(spark, tmp_path):
    for job in match_jobs() + statistics_jobs(standins.ORDERS_AS_OF):
        frame = compute_job(spark, job, rule_book(spark), standin_reader(SF_DIR))
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_run_all_adds_no_shuffle_for_the_store(spark, tmp_path):
    """Neither the union of the batches nor the join with the store moves data again."""
    store = SnapshotPersonaStore(spark, str(tmp_path / "p"))
    store.upsert(spark.createDataFrame([("1", "5")], "userId string, tagsId string"))
    jobs = match_jobs() + statistics_jobs(standins.ORDERS_AS_OF)
    parts = [
        frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        for frame in (
            compute_all(spark, match_jobs(), rule_book(spark), standin_reader(SF_DIR)),
            compute_all(spark, statistics_jobs(standins.ORDERS_AS_OF), rule_book(spark), standin_reader(SF_DIR)),
        )
    ]
    # The batch as it is staged, and then the update from there.
    plans = []
    write = store._write_bucketed
    store._write_bucketed = lambda rows, *rest: (
        plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(rows, *rest)
    )[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        run_all(spark, jobs, rule_book(spark), store, standin_reader(SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Without automatic broadcasts the test users add one shuffle, of the customers.
    assert [plan.count("Exchange hashpartitioning") for plan in plans] == [sum(parts) + 1, 0]
