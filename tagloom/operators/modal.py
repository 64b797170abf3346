"""Most frequent value per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def most_frequent(value: Column, count: Column) -> Column:
    """Aggregate: the value with the highest count. A tie goes to the smallest value, and a
    null value loses every tie."""
    return F.min_by(value, F.struct((-count).alias("c"), value.isNull().alias("n"), value.alias("v")))


def modal_value(frame: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` with the most frequent value of each key; null counts as a value.

    Two aggregates, both combined before their shuffle, so a hot key reaches the second
    shuffle as at most one row per map task.
    """
    counts = frame.groupBy(key, value).agg(F.count(F.lit(1)).alias("__count"))
    return counts.groupBy(key).agg(
        most_frequent(F.col(value), F.col("__count")).alias(value)
    )


def modal_value_window(frame: DataFrame, key: str, value: str) -> DataFrame:
    """The same by ``row_number`` over the counts."""
    counts = frame.groupBy(key, value).agg(F.count(F.lit(1)).alias("__count"))
    order = W.partitionBy(key).orderBy(
        F.col("__count").desc(), F.col(value).asc_nulls_last()
    )
    return (
        counts.withColumn("__rn", F.row_number().over(order))
        .filter(F.col("__rn") == 1)
        .select(key, value)
    )
