"""Rule matching: a user attribute against the values of a tag."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.rule_text import range_bounds
from tagloom.functions.tags import without_nulls
from tagloom.operators.lookup import look_up
from tagloom.sources.rules import TagValues
from tagloom.stores.hadoop import scratch_folder, written

# Up to this many ranges are tested one by one in a projection.
MAX_INLINE_RANGES = 64
RANGE_KEY = "__range_key"


def no_tags() -> Column:
    return F.array().cast("array<string>")


def explode_label(labelled: DataFrame, label: str = "tags") -> DataFrame:
    """``(userId, tagsId)`` rows from a frame with a label.

    A label is an array of tag ids. A null in it keeps the user without a tag; an empty
    one drops the user.
    """
    return labelled.select("userId", F.explode(label).alias("tagsId"))


def label_equal(frame: DataFrame, key: Column, values: TagValues, out: str) -> DataFrame:
    """Add label ``out`` with the id of the value whose rule equals ``key`` as text.

    The label holds one null when nothing matches. Of several values with one rule, the
    one with the highest id counts.
    """
    found = look_up(
        frame, key.cast("string"), values.ids_by_rule(), "__tag", values.small
    )
    return found.withColumn(out, F.array("__tag")).drop("__tag")


def match_equal(
    users: DataFrame, key: Column, values: TagValues, user_id: str = "id", how: str = "left"
) -> DataFrame:
    """``(userId, tagsId)`` by equality. Unmatched users keep a null tag, or go with
    ``how='inner'``."""
    narrow = users.select(F.col(user_id).cast("string").alias("userId"), key.alias("__attr"))
    matched = explode_label(label_equal(narrow, F.col("__attr"), values, "tags"))
    return matched.filter(F.col("tagsId").isNotNull()) if how == "inner" else matched


def label_range(
    frame: DataFrame, key: Column, values: TagValues, out: str, numeric: bool = False
) -> DataFrame:
    """Add label ``out`` with the ids of all values whose range holds ``key``.

    Ranges include both ends. Keys and bounds compare as text, or as whole numbers with
    ``numeric``; a bound that is missing or unreadable matches nothing. Few ranges are
    tested in place, without a join; many are matched by an
    equi-join on dyadic blocks of ranks, which writes scratch tables.
    """
    key = key.try_cast("bigint") if numeric else key.cast("string")
    lo, hi = range_bounds(F.col("rule"), numeric)
    ranges = values.frame.select(
        F.col("id").cast("string").alias("id"), lo.alias("lo"), hi.alias("hi")
    ).filter("lo <= hi")
    rows = ranges.collect() if values.small else None
    # A column of its own, so that the key is worked out once for all ranges.
    keyed = frame.withColumn(RANGE_KEY, key)
    key = F.col(RANGE_KEY)
    if rows is not None and len(rows) <= MAX_INLINE_RANGES:
        tests = [F.when(key.between(F.lit(r["lo"]), F.lit(r["hi"])), F.lit(r["id"])) for r in rows]
        label = without_nulls(F.array(*tests)) if tests else no_tags()
        return keyed.withColumn(out, label).drop(RANGE_KEY)
    hits = ids_by_key(keyed.select(key.alias("key")), ranges)
    found = look_up(keyed, key, hits, out, small=False)
    return found.withColumn(out, F.coalesce(out, no_tags())).drop(RANGE_KEY)


def match_range(
    users: DataFrame, key: Column, values: TagValues, user_id: str = "id", numeric: bool = False
) -> DataFrame:
    """``(userId, tagsId)`` by range: one row per holding range, none for unmatched users."""
    narrow = users.select(F.col(user_id).cast("string").alias("userId"), key.alias("__attr"))
    return explode_label(label_range(narrow, F.col("__attr"), values, "tags", numeric))


def _ranked(keys: DataFrame, ranges: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """``(value, part, bound, asked, ordinal)`` of all distinct keys and range bounds, and
    the highest ordinal.

    Values are sorted over many tasks; ``part`` is the task. The n-th distinct bound has the
    ordinal 2n, and what lies between it and the next one 2n + 1, so that a key is in a range
    exactly if its ordinal is.
    """
    bounds = ranges.select(F.explode(F.array("lo", "hi")).alias("value"), F.lit(True).alias("bound"))
    values = (
        keys.select(F.col("key").alias("value"), F.lit(False).alias("bound"))
        .unionByName(bounds)
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.bool_or("bound").alias("bound"), F.bool_or(~F.col("bound")).alias("asked"))
    )
    dealt = written(values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), folder)
    # One row per task of the sort.
    counts = sorted(dealt.groupBy("part").agg(F.count_if("bound")).collect())
    totals = list(accumulate((n for _, n in counts), initial=0))
    before = keys.sparkSession.createDataFrame(
        [(part, total) for (part, _), total in zip(counts, totals)], "part int, before bigint"
    )
    sorted_part = W.partitionBy("part").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    rank = F.sum(F.col("bound").cast("bigint")).over(sorted_part) + F.col("before")
    ordinal = 2 * rank + F.when(F.col("bound"), 0).otherwise(1)
    ranks = dealt.join(F.broadcast(before), "part").select(
        "value", "part", "bound", "asked", ordinal.alias("ordinal")
    )
    return written(ranks, folder), 2 * totals[-1] + 1


def ids_by_key(keys: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(key, value)``: the ids with ``lo <= key <= hi`` for each distinct key that has any,
    for ``keys(key)`` and ``ranges(id, lo, hi)`` with ``lo <= hi``.

    Keys and ranges meet by rank among the distinct bounds, so that only real hits are
    joined, whatever the bounds look like. Each range is cut into aligned blocks of
    power-of-two size, at most two per size; a rank lies in one block of each size, so both
    sides meet on (size, block). Ranks are probed once per task of the sort, which is also
    what spreads a rank that many keys share.
    """
    folder = scratch_folder(keys.sparkSession)
    ranges = written(ranges, folder)
    ranks, highest = _ranked(keys, ranges, folder)
    ends = ranks.filter("bound")
    blocks = (
        ranges.join(ends.select(F.col("value").alias("lo"), F.col("ordinal").alias("a")), "lo")
        .join(ends.select(F.col("value").alias("hi"), (F.col("ordinal") + 1).alias("b")), "hi")
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(highest.bit_length()))))
        .withColumn("first", F.expr("shiftright(a - 1, level) + 1"))
        .withColumn("last", F.expr("shiftright(b, level)"))
        .filter("first < last")
        .select(
            "id",
            "level",
            F.explode(
                F.array_compact(
                    F.array(
                        F.when(F.col("first") % 2 != 0, F.col("first")),
                        F.when(F.col("last") % 2 != 0, F.col("last") - 1),
                    )
                )
            ).alias("block"),
        )
    )
    asked = ranks.filter("asked")
    probes = (
        asked.select("part", "ordinal")
        .distinct()
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(highest.bit_length()))))
        .withColumn("block", F.expr("shiftright(ordinal, level)"))
    )
    hits = (
        probes.join(blocks, ["level", "block"])
        .groupBy("part", "ordinal")
        .agg(F.array_sort(F.collect_set("id")).alias("value"))
    )
    return asked.select(F.col("value").alias("key"), "part", "ordinal").join(hits, ["part", "ordinal"]).select("key", "value")
