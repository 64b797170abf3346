"""Temperature mixing: source shares to an exponent, realised as block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch, or_empty, whole_row

ROUNDS, POINTS = 8, 31  # each round narrows the exponent to a 32nd: five bisections at once
WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the exponent is to meet; 1 keeps the natural shares, 0 makes all equal.

    ``entropy``: the least entropy of the weights, as a share of that of equal weights.
    ``repeats``: the most often any source may be read.
    Of the exponents that meet it the one nearest to the natural shares is taken for
    ``entropy``, and the one farthest from them for ``repeats``. ``passes`` is the token
    budget over all tokens; None is the least budget that reads every source once in full.
    """

    entropy: float | None = None
    repeats: float | None = None
    passes: float | None = 1.0

    def __post_init__(self):
        if (self.entropy is None) == (self.repeats is None):
            raise ValueError("name an entropy or a number of repeats")
        if self.entropy is not None and not 0 <= self.entropy <= 1:
            raise ValueError("the entropy is a share between 0 and 1")
        if self.repeats is not None and self.repeats < (self.passes or 1.0):
            raise ValueError("the budget alone needs more repeats")


def token_count(text: Column) -> Column:
    """Words, and one for the end of the document, so that none counts nothing."""
    return F.regexp_count(text, F.lit(WORD)).cast("long") + 1


def hash60(*parts: Column) -> Column:
    """60 bits of MD5, which other SQL engines work out alike."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def _met(at: DataFrame, target: Target, passes: Column, n: int) -> Column:
    weight = F.col("power") / F.col("all_power")
    if target.entropy is not None:
        return -F.sum(weight * F.ln(weight)) >= target.entropy * math.log(n) - 1e-12
    return F.max(weight / F.col("share")) * passes <= target.repeats + 1e-12


def exponent(sources: DataFrame, target: Target) -> float:
    """The exponent for a table with one ``share`` per source. Every round sums all sources
    at 31 exponents; only these sums come to the driver."""
    n = sources.count()
    if n < 2:
        return 1.0
    low, high = 0.0, 1.0

    def good(points: list[float]) -> list[bool]:
        grid = sources.select("share", F.explode(F.array(*[F.lit(x) for x in points])).alias("x"))
        power = grid.withColumn("power", F.pow("share", F.col("x")))
        total = power.groupBy("x").agg(F.sum("power").alias("all_power"), F.min(F.col("power") / F.col("share")).alias("least"))
        at = power.join(F.broadcast(total), "x")
        passes = F.lit(target.passes) if target.passes else F.max(F.col("all_power") / F.col("least"))
        rows = at.groupBy("x").agg(_met(at, target, passes, n).alias("good")).collect()
        met = {r["x"]: r["good"] for r in rows}
        return [met[x] for x in points]

    natural, equal = good([1.0, 0.0])
    if target.entropy is not None and natural:
        return 1.0
    if target.repeats is not None and equal:
        return 0.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / (POINTS + 1) for i in range(POINTS + 2)]
        met = good(points[1:-1])
        # Entropy is met up to some exponent, repeats from some exponent on.
        below = sum(met) if target.entropy is not None else POINTS - sum(met)
        low, high = points[below], points[below + 1]
    return low if target.entropy is not None else high


def mix(docs: DataFrame, target: Target, seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as its source's budget has it, in training order.

    A source's weight is its share of all tokens to an exponent that meets ``target``, over
    the sum of these; its budget is that weight of the token budget. The source is read in
    passes. Each pass is a permutation of the source's blocks and of the documents in each;
    the last pass stops with the document that meets the budget.

    Adds ``pass`` (from 0), ``block`` and ``start`` (the source's tokens before the document
    in that pass); columns of these names are overwritten. A document's tokens are its words
    and one end. A null source counts as the empty name, a null text as empty. Equal rows
    are ordered one after the other. An empty table gives an empty result.

    A source of n documents has about sqrt(n) blocks, so that a source with a third of all
    rows is ordered by tasks of sqrt(n) rows, and one window of sqrt(n) block totals.
    """
    scratch = Scratch(docs)
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    rows = docs.select(whole_row(docs), name.alias("name"), token_count(or_empty(F.col("text"))).alias("tokens"))
    sums = scratch.write(rows.groupBy("name").agg(F.sum("tokens").alias("there"), F.count(F.lit(1)).alias("docs")))
    every = sums.agg(F.sum("there")).first()[0] or 1
    shares = sums.withColumn("share", F.col("there") / F.lit(float(every)))
    x = exponent(shares, target)
    power = shares.withColumn("power", F.pow("share", F.lit(x)))
    total, least = power.agg(F.sum("power"), F.min(F.col("power") / F.col("share"))).first()
    passes = target.passes or ((total or 1.0) / (least or 1.0))
    budget = F.floor(F.col("power") / F.lit(total or 1.0) * F.lit(passes * every) + 0.5)
    if not target.passes:  # the least-weighted source is to be whole in spite of rounding
        budget = F.greatest(budget, F.col("there"))
    whole, rest = F.floor(F.col("budget") / F.col("there")), F.col("budget") % F.col("there")
    plan = scratch.small_side(
        power.withColumn("budget", budget)
        .select(
            "name",
            whole.alias("whole"),
            rest.alias("rest"),
            F.sequence(F.lit(0), (whole - F.when(rest == 0, 1).otherwise(0)).cast("int"), F.lit(1)).alias("passes"),
            F.ceil(F.sqrt("docs")).alias("blocks"),
        )
        .filter("whole > 0 OR rest > 0")
    )
    doc = F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))
    blocked = rows.join(plan, "name").withColumn("block", F.pmod(hash60(F.lit(seed), doc), F.col("blocks")))
    block = ["name", "pass", "block"]
    dealt = blocked.withColumn("pass", F.explode("passes")).withColumn("turn", hash60(F.lit(seed), F.col("pass"), doc))
    in_block = F.sum("tokens").over(
        W.partitionBy(*block).orderBy("turn", "row.doc_id", "tokens").rowsBetween(W.unboundedPreceding, -1)
    )
    totals = (
        blocked.groupBy("name", "block", "passes")
        .agg(F.sum("tokens").alias("held"))
        .select("name", "block", "held", F.explode("passes").alias("pass"))
    )
    turn = hash60(F.lit(seed), F.lit("block"), F.col("name"), F.col("pass"), F.col("block"))
    of_block = F.sum("held").over(
        W.partitionBy("name", "pass").orderBy(turn, "block").rowsBetween(W.unboundedPreceding, -1)
    )
    begins = scratch.write(totals.select(*block, F.coalesce(of_block, F.lit(0)).alias("begin")))
    own = [c for c in docs.columns if c not in ("pass", "block", "start")]
    start = F.coalesce("in_block", F.lit(0)) + F.col("begin")
    return (
        dealt.withColumn("in_block", in_block)
        .join(begins, block)
        .filter((F.col("pass") < F.col("whole")) | (start < F.col("rest")))
        .select(*[F.col(f"row.`{c}`") for c in own], "pass", "block", start.alias("start"))
    )


def mixed_sources(docs: DataFrame, target: Target) -> DataFrame:
    return mix(docs.select("doc_id", "source", "text"), target).select("doc_id", "source", "pass", "block", "start")
