"""Equi-joins with a keyed side whose size is either proven small or unknown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32
# Bounds of the search for hot keys: how many may come out, and how many each task tracks.
MOST_HOT_KEYS, TRACKED_KEYS = 1_000, 40_000
_SALT = "__salt"


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Shuffle join that spreads each left key over ``salts`` tasks.

    Null and hot keys of the left side would otherwise meet in one task. The right side is
    repeated once per salt, so it should be the smaller one.
    """
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts))
    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    return (
        left.withColumn(_SALT, spread)
        .join(right.withColumn(_SALT, every_salt), [*on, _SALT], how)
        .drop(_SALT)
    )


def hot_keys(keys: DataFrame, share: int) -> list:
    """The values of the column ``__key`` that more than one of ``share`` rows have, and
    perhaps a few that fewer have; at most ``MOST_HOT_KEYS``.

    A sketch of frequent items, combined over the tasks, finds them in one pass.
    """
    top = F.expr(f"approx_top_k(__key, {MOST_HOT_KEYS}, {TRACKED_KEYS})").alias("top")
    row = keys.select("__key").agg(F.count(F.lit(1)).alias("rows"), top).first()
    found = (item for item in row["top"] or () if item["item"] is not None)
    return [item["item"] for item in found if item["count"] * share > row["rows"]]


def hot_key_join(keyed: DataFrame, table: DataFrame, out: str) -> DataFrame:
    """Left join of ``keyed(__key, ...)`` with ``table(__key, out)``, which has unique keys.

    Rows of hot keys take their value from a broadcast of these keys' rows alone, a bounded
    number. They, and rows without a key, then pass through the shuffle join with a number
    in the key's place that spreads them over the tasks and meets nothing. The table is
    shuffled once, without copies.
    """
    share = 2 * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(keyed, share)
    own, shared = F.col("__key"), F.lit(None).cast(table.schema[out].dataType)
    is_hot = F.lit(False)
    if hot:
        chosen = table.filter(own.isin(hot)).withColumnRenamed(out, "__shared")
        keyed = keyed.join(F.broadcast(chosen), "__key", "left")
        shared, is_hot = F.col("__shared"), own.isin(hot)
    alone = own.isNull() | is_hot
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in keyed.columns])
    # Always 0, but not a constant, which the optimiser would take out of the join.
    nought = F.pmod(F.xxhash64("__key"), F.lit(1).cast("bigint"))
    keyed = keyed.withColumns(
        {
            "__spread": F.when(alone, spread).otherwise(nought),
            "__cold": F.when(~alone, own),
            "__value": shared,
        }
    )
    cold = table.select(own.alias("__cold"), nought.alias("__spread"), F.col(out).alias("__found"))
    joined = keyed.join(cold, ["__cold", "__spread"], "left").withColumn(out, F.coalesce("__found", "__value"))
    return joined.drop("__cold", "__spread", "__value", "__found", "__shared")


def look_up(frame: DataFrame, key: Column, table: DataFrame, out: str, small: bool) -> DataFrame:
    """Add column ``out`` from ``table(key, value)``, null where the key is absent.

    ``table`` has unique keys. It is broadcast only when the caller has proven it small.
    """
    keyed = frame.withColumn("__key", key)
    table = table.select(F.col("key").alias("__key"), F.col("value").alias(out))
    if small:
        joined = keyed.join(F.broadcast(table), "__key", "left")
    else:
        joined = hot_key_join(keyed, table, out)
    return joined.drop("__key")
