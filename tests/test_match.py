from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import match_equal, match_range
from tagloom.operators import match as match_module
from tagloom.operators.lookup import salted_join
from tagloom.sources import TagValues


def values(spark, rows, small=True):
    if small:
        return TagValues.local(spark, rows)
    return TagValues(spark.createDataFrame(rows, "id int, rule string"), None)


def pairs(frame):
    assert frame.columns == ["userId", "tagsId"]
    assert [t for _, t in frame.dtypes] == ["string", "string"]
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("small", [True, False])
def test_match_equal(spark, ansi, small):
    users = spark.createDataFrame([(1, 1), (2, 2), (3, 7), (4, None)], "id bigint, gender int")
    rules = values(spark, [(5, "1"), (6, "2"), (9, "2"), (10, None)], small)
    assert pairs(match_equal(users, F.col("gender"), rules)) == [
        ("1", "5"),
        ("2", "9"),
        ("3", None),
        ("4", None),
    ]
    assert pairs(match_equal(users, F.col("gender"), rules, how="inner")) == [("1", "5"), ("2", "9")]


def test_match_equal_without_rules(spark):
    users = spark.createDataFrame([(1, "a")], "id bigint, job string")
    assert pairs(match_equal(users, F.col("job"), values(spark, []))) == [("1", None)]


BIRTHDAYS = ["19491231", "19500101", "19550505", "19591231", "19600101", None, "19580601"]
AGE_RULES = [(15, "19500101-19591231"), (16, "19580101-19590101"), (17, "1950"), (18, "b-a")]


@pytest.mark.parametrize("small", [True, False])
def test_match_range_text(spark, ansi, small):
    users = spark.createDataFrame(list(enumerate(BIRTHDAYS)), "id bigint, birthday string")
    found = match_range(users, F.col("birthday"), values(spark, AGE_RULES, small))
    assert pairs(found) == [("1", "15"), ("2", "15"), ("3", "15"), ("6", "15"), ("6", "16")]


@pytest.mark.parametrize("small", [True, False])
def test_match_range_numeric(spark, ansi, small):
    days = [(1, 8), (2, 15), (3, 16), (4, 100), (5, None), (6, -1)]
    users = spark.createDataFrame(days, "id bigint, days int")
    rules = values(spark, [(24, "0-15"), (25, "5"), (26, "x-y")], small)
    assert pairs(match_range(users, F.col("days"), rules, numeric=True)) == [("1", "24"), ("2", "24")]


@pytest.mark.parametrize("small", [True, False])
def test_match_range_without_ranges(spark, small):
    users = spark.createDataFrame([(1, 8)], "id bigint, days int")
    assert pairs(match_range(users, F.col("days"), values(spark, [(1, "5")], small), numeric=True)) == []
    assert pairs(match_range(users, F.col("days"), values(spark, [(1, "5")], small))) == []


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("numeric", [True, False])
def test_many_ranges_against_brute_force(spark, monkeypatch, small, numeric):
    monkeypatch.setattr(match_module, "MAX_INLINE_RANGES", 5)
    rng = random.Random(7)
    if numeric:
        keys = [rng.choice([rng.randrange(-50, 400), rng.randrange(10**18), 2**63 - 1]) for _ in range(150)]
        ends = [sorted(rng.choice([rng.randrange(300), rng.randrange(10**18)]) for _ in "ab") for _ in range(60)]
        ends += [[0, 2**63 - 1], [2**63 - 1, 2**63 - 1], [0, 0]]
    else:
        words = ["", "a", "ab", "é", "éé", "用户", "zz", "a b"]
        keys = ["".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in range(150)]
        ends = [sorted("".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in "ab") for _ in range(60)]
    rules = [(i, f"{lo}-{hi}") for i, (lo, hi) in enumerate(ends)]
    users = spark.createDataFrame(
        [(i, key) for i, key in enumerate(keys)], f"id bigint, k {'bigint' if numeric else 'string'}"
    )
    order = (lambda v: v) if numeric else (lambda v: v.encode())
    expected = sorted(
        (str(u), str(i))
        for u, key in enumerate(keys)
        for i, (lo, hi) in enumerate(ends)
        if order(lo) <= order(key) <= order(hi)
    )
    found = match_range(users, F.col("k"), values(spark, rules, small), numeric=numeric)
    assert pairs(found) == sorted(expected, key=repr)


def test_an_outlying_range_joins_no_more_than_hits(spark):
    names = spark.range(2000).select(F.format_string("Customer#%09d", "id").alias("key"))
    narrow = spark.range(2000).select(
        F.col("id").cast("string").alias("id"),
        F.format_string("Customer#%09d", "id").alias("lo"),
        F.format_string("Customer#%09d", F.col("id") + 1).alias("hi"),
    )
    ranges = narrow.union(spark.createDataFrame([("all", "A", "Z")], narrow.schema))
    found = match_module.ids_by_key(names, ranges)
    assert found.agg(F.sum(F.size("value"))).first()[0] == 2000 + 2000 + 1999
    # The probes: each rank once in each of the levels, whatever the ranges are.
    ranks, highest = match_module._ranked(names, ranges, match_module.scratch_folder(spark))
    assert ranks.filter("asked").select("ordinal").distinct().count() == 2000
    assert highest == 2 * 2003 + 1


def test_salted_join_spreads_hot_and_null_keys(spark):
    third = F.col("id") % 3
    key = F.when(third == 1, "hot").when(third == 2, F.col("id").cast("string"))
    left = spark.range(4000).select("id", key.alias("k"))
    right = spark.createDataFrame([("hot", "v")], "k string, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"])
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert joined.count() == 4000
        assert joined.filter("v is not null").count() == 1333
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 1000


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    users = spark.range(1000).select("id", F.col("id").cast("string").alias("k"))
    equal = plan_of(match_equal(users, F.col("k"), values(spark, [(1, "a")])))
    assert "BroadcastHashJoin" in equal and "Exchange hashpartitioning" not in equal
    inline = plan_of(match_range(users, F.col("k"), values(spark, [(1, "a-b")])))
    assert "Join" not in inline and "Exchange" not in inline
    many = plan_of(match_range(users, F.col("k"), values(spark, [(1, "a-b")], small=False)))
    for plan in (equal, inline, many):
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_hot_keys_are_spread_without_copies(spark):
    from tagloom.operators.lookup import hot_key_join, hot_keys, look_up

    n = 9000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string"))
    left = spark.range(n).select("id", key.alias("__key"))
    rules = spark.range(n).select(F.col("id").cast("string").alias("__key"), (F.col("id") * 2).alias("v"))
    rules = rules.unionByName(spark.createDataFrame([("hot", -1)], "`__key` string, v long"))
    assert hot_keys(left, 16) == ["hot"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hot_key_join(left, rules, "v")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * n / 8
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Generate") == 0 and plan.count("BroadcastHashJoin") == 1
        rows = joined.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.columns == ["__key", "id", "v"] or set(joined.columns) == {"__key", "id", "v"}
    wanted = {i: -1 if i % 3 == 0 else None if i % 3 == 1 else 2 * i for i in range(n)}
    assert len(rows) == n and {r["id"]: r["v"] for r in rows} == wanted
    # No rows, no keys, numbers as keys.
    numbers = spark.createDataFrame([(1, "a"), (2, None)], "key long, value string")
    frame = spark.createDataFrame([(1, 7), (1, 8), (None, 9), (3, 10)], "k long, row int")
    found = look_up(frame, F.col("k"), numbers, "found", small=False).collect()
    assert sorted((r["row"], r["found"]) for r in found) == [(7, "a"), (8, "a"), (9, None), (10, None)]
    assert look_up(frame.limit(0), F.col("k"), numbers, "found", small=False).count() == 0
