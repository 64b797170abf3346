from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import merge_tags
from tagloom.operators import merge_with_store, one_row_per_user
from tagloom.operators.merge import unite_batches

SCHEMA = "new string, old string"


def merged(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return [r["m"] for r in frame.select(merge_tags(F.col("new"), F.col("old")).alias("m")).collect()]


def test_merge_tags(spark, ansi):
    rows = [("5", "5,18"), (None, "5"), ("5", None), (None, None), (None, "5,5"), ("10", "9,x,2"), ("7", "7,7"), ("10,9", "007"), ("3", "-2,11"), ("a", "")]
    assert merged(spark, rows) == [
        "5,18", "5", "5", None, "5,5", "2,9,10,x", "7", "007,9,10", "-2,3,11", ",a"
    ]


tags = st.lists(st.sampled_from(["1", "2", "10", "33", "x"]), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(tags, tags), min_size=20, max_size=40))
def test_merge_is_set_union(spark, cases):
    rows = [(",".join(new), ",".join(old)) for new, old in cases]
    one_way = merged(spark, rows)
    assert one_way == merged(spark, [(old, new) for new, old in rows])
    assert one_way == merged(spark, [(m, old) for m, (_, old) in zip(one_way, rows)])
    for m, (new, old) in zip(one_way, cases):
        assert sorted(m.split(",")) == sorted(set(new) | set(old))


def test_merge_with_store(spark):
    new = spark.createDataFrame([("1", "5"), ("1", "6"), ("2", None), ("3", "7"), ("4", None)], "userId string, tagsId string")
    old = spark.createDataFrame([("1", "9,5"), ("2", "8,8"), ("9", "1")], "userId string, tagsId string")
    assert sorted(map(tuple, merge_with_store(new, old).collect())) == [
        ("1", "5,6,9"),
        ("2", "8,8"),
        ("3", "7"),
        ("4", None),
    ]


def test_one_row_per_user(spark):
    first = spark.createDataFrame([("1", ["5"]), ("1", ["5"]), ("2", ["7", "6"]), ("3", None)], "userId string, tags array<string>")
    second = spark.createDataFrame([("1", ["10", "9"]), ("4", None)], "userId string, tags array<string>")
    assert dict(map(tuple, one_row_per_user(first, second).collect())) == {
        "1": ["5", "9", "10"],
        "2": ["7", "6"],
        "3": None,
        "4": None,
    }


def test_unite_batches_keeps_equal_partitioning(spark):
    """Frames aggregated by user are united without another shuffle."""

    def counts(n, low, high):
        ids = spark.range(n).select((F.col("id") % 500).cast("string").alias("userId"), "id")
        counted = ids.groupBy("userId").agg(F.count("*").cast("string").alias("c"))
        return counted.select("userId", F.array("c").alias("tags")).filter(
            F.col("userId").cast("int").between(low, high)
        )

    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        union = unite_batches(counts(5000, 0, 399), counts(100_000, 100, 499), counts(10_000, 0, 499))
        plan = union._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
        expected = [
            (str(i), (["10"] if i < 400 else []) + ["20"] + (["200"] if i >= 100 else [])) for i in range(500)
        ]
        assert sorted(map(tuple, union.collect())) == sorted(expected)
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_plan_grows_in_step_with_the_batches(spark):
    from tagloom.operators.merge import unite_batches

    def size(n):
        batch = spark.createDataFrame([("1", ["5"])], "userId string, tags array<string>")
        return len(unite_batches(*[batch] * n)._jdf.queryExecution().analyzed().toString())

    few, some, many = size(3), size(10), size(30)
    assert many < 8 * some and some < 8 * few


def test_many_batches_unite_in_canonical_order(spark):
    from tagloom.operators.merge import unite_batches

    batches = [
        spark.createDataFrame([("1", [str(30 - i)]), (f"only {i}", ["9", "9"])], "userId string, tags array<string>")
        for i in range(12)
    ]
    rows = {r["userId"]: r["tags"] for r in unite_batches(*batches).collect()}
    assert rows["1"] == [str(i) for i in range(19, 31)]
    assert rows["only 3"] == ["9", "9"]
