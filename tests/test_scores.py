from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagloom.functions import Band, as_of_today, epoch_day, recency_days, score_bands, text_day
from tagloom.operators import (
    modal_value,
    modal_value_window,
    order_profile,
    order_totals,
    psm_features,
    psm_score,
    rfe_features,
    rfm_features,
)
from tagloom.operators import scores


@pytest.mark.parametrize(
    ("bands", "given", "expected"),
    [
        (scores.RFM_RECENCY, [-1, 0, 1, 3, 4, 6, 7, 9, 10, 15, 16, None], [0, 0, 5, 5, 4, 4, 3, 3, 2, 2, 1, 0]),
        (scores.RFM_FREQUENCY, [0, 1, 49, 50, 99, 100, 149, 150, 199, 200], [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]),
        (scores.RFM_MONETARY, [99999.99, 100000, 350000, 500000, 850000, None], [1, 2, 3, 4, 5, 0]),
        (scores.RFE_RECENCY, [-1, 0, 15, 16, 30, 31, 80, 81, 95, 96, None], [0, 5, 5, 4, 4, 3, 3, 2, 2, 1, 0]),
        (scores.RFE_FREQUENCY, [249, 250, 399, 400, 529, 530, 560, 561, None], [1, 2, 2, 3, 3, 4, 4, 5, 0]),
        (scores.RFE_ENGAGEMENTS, [48, 49, 50, 219, 220, 239, 240, 260, 261], [1, 0, 2, 2, 3, 3, 4, 4, 5]),
        ((), [1, None], [0, 0]),
        ((Band(7),), [1, None], [7, 0]),
    ],
)
def test_bands(spark, bands, given, expected):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(given)]
    frame = spark.createDataFrame(rows, "i int, v double").select("i", score_bands("v", bands).alias("s"))
    assert [r["s"] for r in sorted(frame.collect())] == expected


def test_recency(spark, ansi):
    rows = [(1_693_526_400, "2023-09-01 10:00:00"), (None, "soon"), (86_399, None)]
    frame = spark.createDataFrame(rows, "t bigint, s string")
    days = frame.select(
        recency_days(epoch_day(F.col("t")), "2023-09-03"),
        recency_days(epoch_day(F.col("t").cast("string")), dt.date(2023, 9, 3)),
        recency_days(text_day(F.col("s")), "2023-09-03"),
    )
    assert [tuple(r) for r in days.collect()] == [(2, 2, 2), (None, None, None), (19603, 19603, None)]
    today = spark.range(1).select(F.datediff(F.current_date(), as_of_today(1140)).alias("n"))
    assert today.first()["n"] == 1140


@pytest.mark.parametrize("modal", [modal_value, modal_value_window])
def test_modal_value(spark, modal):
    rows = [("u1", "a"), ("u1", "a"), ("u1", "b"), ("u2", "b"), ("u2", "a"), ("u3", None), ("u3", None), ("u3", "a"), ("u4", None), ("u4", "z"), (None, "x")]
    frame = spark.createDataFrame(rows, "u string, v string")
    assert {r["u"]: r["v"] for r in modal(frame, "u", "v").collect()} == {
        "u1": "a",
        "u2": "a",
        "u3": None,
        "u4": "z",
        None: "x",
    }


ORDER_SCHEMA = (
    "memberid string, ordersn string, orderamount double, couponcodevalue double, "
    "paymentcode string, finishtime bigint"
)
ORDERS = [
    ("1", "a", 100.0, 10.0, "ali", 86_400),
    ("1", "b", 100.0, 0.0, "ali", 172_800),
    ("2", "c", 50.0, None, "wx", 0),
    ("3", "d", 0.0, 5.0, "wx", 0),
    ("4", None, None, None, None, None),
]


def test_features(spark, ansi):
    orders = spark.createDataFrame(ORDERS, ORDER_SCHEMA)
    assert sorted(map(tuple, rfm_features(orders, "1970-01-05").collect())) == [
        ("1", 2, 2, 200.0),
        ("2", 4, 1, 50.0),
        ("3", 4, 1, 0.0),
        ("4", None, 0, None),
    ]
    features = psm_features(orders)
    assert sorted(map(tuple, features.collect())) == [
        ("1", 1, 2, 10.0, 200.0),
        ("2", 0, 1, None, 50.0),
        ("3", 1, 1, 5.0, 0.0),
        ("4", 0, 0, None, None),
    ]
    [only] = psm_score(features).collect()
    assert only["userId"] == "1" and only["psm"] == pytest.approx(0.65)
    logs = [("1", "/a", "2024-01-02 01:00:00"), ("1", "/a", "2024-01-03 00:00:00"), ("1", None, "bad"), ("2", "/b", "2024-01-01")]
    visits = spark.createDataFrame(logs, "global_user_id string, loc_url string, log_time string")
    assert sorted(map(tuple, rfe_features(visits, "2024-01-11").collect()), key=repr) == [
        ("1", None, 2, 1),
        ("2", 10, 1, 1),
    ]


def test_order_profile_equals_its_parts(spark):
    rows = ORDERS + [("1", "e", 7.0, 1.0, "wx", 5)]
    orders = spark.createDataFrame(rows, ORDER_SCHEMA)
    profile = order_profile(orders)
    totals = order_totals(orders)
    assert sorted(map(tuple, profile.drop("payment").collect())) == sorted(map(tuple, totals.collect()))
    modes = modal_value(orders, "memberid", "paymentcode")
    assert sorted(map(tuple, profile.select("userId", "payment").collect())) == sorted(map(tuple, modes.collect()))


def test_totals_follow_the_columns(spark):
    orders = spark.createDataFrame(ORDERS, ORDER_SCHEMA).select("memberid", "finishtime")
    assert order_totals(orders).columns == ["userId", "last_finish"]


def test_distinct_count_spreads_a_hot_user(spark):
    """The plan de-duplicates by (user, page) before it gathers by user."""
    visits = spark.range(100).select(
        F.lit("1").alias("global_user_id"), F.col("id").cast("string").alias("loc_url"), F.lit("2024-01-01").alias("log_time")
    )
    plan = rfe_features(visits, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "loc_url" in exchanges[1]


TIMES = [
    "2024-01-05 10:00:00", "2024-1-5 00:00", "2024-12-31", "", None, "zzz", "2024-09-30T", "é024-01-01x", "日本語日本語日本語日本語", "2024",
]


def test_latest_day_needs_no_sort(spark):
    from tagloom.operators.profiles import log_profile, text_of_order, text_order

    rows = [(str(i % 4), t, f"u{i % 3}") for i, t in enumerate(TIMES * 3)]
    logs = spark.createDataFrame(rows, "global_user_id string, log_time string, loc_url string")
    plain = logs.groupBy(F.col("global_user_id").alias("userId")).agg(F.max(F.substring("log_time", 1, 10)).alias("day"))
    both = rfe_features(logs, "2025-01-01").join(plain, "userId").withColumn("wanted", recency_days(text_day(F.col("day")), "2025-01-01"))
    assert [r for r in both.collect() if r["recency"] != r["wanted"]] == [] and both.count() == 4
    plan = rfe_features(logs, "2025-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    ascii_days = [t[:10] for t in TIMES if t is not None and t.isascii()]
    frame = spark.createDataFrame([(t,) for t in ascii_days], "t string").select("t", text_order(F.col("t")).alias("n"))
    back = frame.select("t", "n", text_of_order(F.col("n")).alias("back")).collect()
    assert all(r["t"] == r["back"] for r in back)
    assert [r["t"] for r in sorted(back, key=lambda r: r["n"])] == sorted(ascii_days)
    assert log_profile(logs.limit(0)).count() == 0


def test_estimated_pages_and_united_logs(spark):
    from tagloom.operators.profiles import log_profile, log_state, profile_of_log_state, unite_log_states

    logs = spark.range(6000).select(
        (F.col("id") % 3).cast("string").alias("global_user_id"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")).alias("log_time"),
        F.when(F.col("id") % 50 > 0, (F.col("id") % 2000).cast("string")).alias("loc_url"),
    )
    exact = {r["userId"]: r for r in log_profile(logs).collect()}
    parts = [log_state(logs.filter(F.col("log_time") < "2024-01-15")), log_state(logs.filter(F.col("log_time") >= "2024-01-10"))]
    for found in (log_profile(logs, approx=True), profile_of_log_state(unite_log_states(*parts))):
        for r in found.collect():
            wanted = exact[r["userId"]]
            assert r["last_log"] == wanted["last_log"] and abs(r["pages"] - wanted["pages"]) <= wanted["pages"] / 10


def test_quantile_bands(spark):
    frame = spark.createDataFrame([(float(i), 7, None) for i in range(100)], "a double, b int, c double")
    bands = scores.quantile_bands(frame, {"a": True, "b": True, "c": False})
    scored = frame.select(*[score_bands(c, bands[c]).alias(c) for c in "abc"]).collect()
    counts = [sum(r["a"] == s for r in scored) for s in range(1, 6)]
    assert counts == [20, 20, 20, 20, 20]
    assert {r["b"] for r in scored} == {1} and {r["c"] for r in scored} == {0}
    down = scores.quantile_bands(frame, {"a": False})["a"]
    first = frame.orderBy("a").select(score_bands("a", down).alias("s")).first()
    assert first["s"] == 5
    assert scores.quantile_bands(frame.limit(0), {"a": True})["a"]
