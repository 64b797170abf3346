"""Logical inputs of the tag jobs, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-02-01"

# Rule rows (id, pid, rule) of the test queries.
RULES = [
    (4, 2, "inType=parquet##esIndex=users##selectFields=id,gender"),
    (5, 4, "1"),
    (6, 4, "2"),
    (7, 2, "inType=parquet##esIndex=users##selectFields=id,job"),
    (8, 7, "AUTOMOBILE"),
    (9, 7, "BUILDING"),
    (10, 7, "HOUSEHOLD"),
    (11, 7, "MACHINERY"),
    (14, 2, "inType=parquet##esIndex=users##selectFields=id,birthday"),
    (15, 14, "19950101-19950131"),
    (16, 14, "19950201-19950430"),
    (17, 14, "19950415-19951231"),
    (18, 14, "19960101-19971231"),
    (19, 14, "19980101"),
    (23, 2, "inType=parquet##esIndex=orders##selectFields=memberid,finishtime"),
    (24, 23, "0-7"),
    (25, 23, "8-30"),
    (26, 23, "31-100"),
    (27, 23, "90-365"),
    (28, 23, "later-never"),
    (29, 2, "inType=parquet##esIndex=orders##selectFields=memberid,paymentcode"),
    (30, 29, "1-URGENT"),
    (31, 29, "2-HIGH"),
    (32, 29, "3-MEDIUM"),
    (33, 29, "4-NOT SPECIFIED"),
    (37, 3, "inType=parquet##esIndex=orders##selectFields=memberid,ordersn,orderamount,finishtime"),
    (38, 37, "top"),
    (39, 37, "high"),
    (40, 37, "upper"),
    (41, 37, "middle"),
    (42, 37, "lower"),
    (43, 37, "low"),
    (44, 37, "last"),
    (45, 3, "inType=parquet##esIndex=logs##selectFields=global_user_id,loc_url,log_time"),
    (46, 45, "very active"),
    (47, 45, "active"),
    (48, 45, "quiet"),
    (49, 45, "asleep"),
    (
        50,
        3,
        "inType=parquet##esIndex=orders"
        "##selectFields=memberid,ordersn,orderamount,couponcodevalue",
    ),
    (51, 50, "extreme"),
    (52, 50, "sensitive"),
    (53, 50, "average"),
    (54, 50, "mild"),
    (55, 50, "none"),
    (61, 2, "inType=parquet##esIndex=users##selectFields=id,politicalface"),
    (62, 61, "3"),
    (63, 61, "7"),
    (64, 61, "11"),
    (65, 2, "inType=parquet##esIndex=users##selectFields=id,marriage"),
    (66, 65, "0"),
    (67, 65, "1"),
    (68, 65, "2"),
]


# Declared, so that opening a table takes no job to read its schema.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_discount double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers. The birthday is the day of the first order; codes come from other columns."""
    first_orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").cast("date").cast("string").alias("birthday"))
    )
    return (
        customers(spark, sf_dir)
        .join(first_orders, F.col("id") == F.col("c_custkey"), "left")
        .drop("c_custkey")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users`` without the birthday."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") < 5000, 1).otherwise(2).alias("gender"),
        F.col("c_mktsegment").alias("job"),
        F.floor(F.col("c_acctbal") / 4000).cast("int").alias("marriage"),
        F.col("c_nationkey").alias("politicalface"),
    )


def orders(spark: SparkSession, sf_dir: str, coupons: bool = True) -> DataFrame:
    """Orders; the coupon value is the discount given on an order's lines."""
    base = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("memberid"),
        F.col("o_orderkey").alias("ordersn"),
        F.col("o_totalprice").alias("orderamount"),
        F.col("o_orderpriority").alias("paymentcode"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("finishtime"),
    )
    if not coupons:
        return base
    discounts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("ordersn"))
        .agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("couponcodevalue"))
    )
    return base.join(discounts, "ordersn", "left")


def logs(spark: SparkSession, sf_dir: str, visitors: int = 1) -> DataFrame:
    """Page views. With more ``visitors`` each user's are dealt to so many visitors."""
    user = F.col("user_id").cast("string")
    if visitors > 1:
        user = F.concat(user, F.lit("-"), (F.col("event_id") % visitors).cast("string"))
    return table(spark, sf_dir, "events").select(
        user.alias("global_user_id"),
        F.col("props").alias("loc_url"),
        F.col("ts").cast("string").alias("log_time"),
    )
