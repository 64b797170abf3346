"""Merging new tags with stored ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import canonical, merge_tag_lists, to_tag_list, to_tags_id


def as_tag_lists(new: DataFrame) -> DataFrame:
    """``(userId, tagsId)`` to ``(userId, tags array<string>)``."""
    return new.select(F.col("userId").cast("string").alias("userId"), to_tag_list(F.col("tagsId")).alias("tags"))


def one_row_per_user(*batches: DataFrame) -> DataFrame:
    """Union of ``(userId, tags)`` batches, reduced to one row per user.

    A single array passes through as it is. Several are united in canonical order. The
    set of arrays is built before the shuffle, so a hot user costs one row per map task.
    """
    together = reduce(DataFrame.unionByName, batches)
    arrays = F.col("__arrays")
    return (
        together.groupBy("userId")
        .agg(F.collect_set("tags").alias("__arrays"))
        .select(
            "userId",
            F.when(F.size(arrays) == 1, arrays[0])
            .when(F.size(arrays) > 1, canonical(F.array_distinct(F.flatten(arrays))))
            .alias("tags"),
        )
    )


def unite_batches(*batches: DataFrame) -> DataFrame:
    """Union of ``(userId, tags)`` batches that each have one row per user.

    Each batch gets a column of its own, so one grouping puts a user's arrays side by side.
    Batches that come hash-partitioned by user are not shuffled again.
    """
    columns = [f"__tags_{i}" for i in range(len(batches))]
    absent = F.lit(None).cast("array<string>")
    parts = [
        batch.select(
            "userId", *[(F.col("tags") if c == own else absent).alias(c) for c in columns]
        )
        for own, batch in zip(columns, batches)
    ]
    side_by_side = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("userId")
        .agg(*[F.any_value(c, True).alias(c) for c in columns])
    )
    # One flatten and one sort, however many batches there are; each step is a column of
    # its own, so that the sort reads columns and not the expressions behind them.
    arrays = F.col("__arrays")
    return (
        side_by_side.select("userId", F.array_compact(F.array(*columns)).alias("__arrays"))
        .select("userId", "__arrays", F.array_distinct(F.flatten(arrays)).alias("__every"))
        .select(
            "userId",
            F.when(F.size(arrays) == 1, arrays[0])
            .when(F.size(arrays) > 1, canonical(F.col("__every")))
            .alias("tags"),
        )
    )


def merge_with_store(new: DataFrame, old: DataFrame) -> DataFrame:
    """Users of the new batch with their tags united with the stored ones.

    Both sides and the result are ``(userId, tagsId)``. Stored users outside the batch do
    not appear. An old tag is never removed, even when a newer one contradicts it.
    """
    fresh = one_row_per_user(as_tag_lists(new)).withColumnRenamed("tags", "new_tags")
    stored = as_tag_lists(old).withColumnRenamed("tags", "old_tags")
    merged = merge_tag_lists(F.col("new_tags"), F.col("old_tags"))
    return fresh.join(stored, "userId", "left").select(
        "userId", to_tags_id(merged).alias("tagsId")
    )
