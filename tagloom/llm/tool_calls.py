"""Tool-call linking: calls and results joined by identifier, ordered, checked, serialised."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import Scratch


@dataclass(frozen=True)
class Field:
    """One argument of a tool: its JSON type as ``schema_of_variant`` names it, such as
    STRING, BIGINT or BOOLEAN, and whether it must be there and not be empty."""

    name: str
    type: str = "STRING"
    required: bool = True


Schemas = dict[str, tuple[Field, ...]]


def _fits(arguments: Column, fields: tuple[Field, ...]) -> Column:
    """Whether a JSON object has the required fields, no unknown ones, and fitting types."""
    known = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array().cast("array<string>")
    checks = [F.size(F.array_except(F.json_object_keys(arguments), known)) == 0]
    parsed = F.try_parse_json(arguments)
    for field in fields:
        value = F.try_variant_get(parsed, f"$.{field.name}", "variant")
        right = F.schema_of_variant(value) == field.type
        if field.type == "STRING" and field.required:
            right = right & (F.length(F.try_variant_get(parsed, f"$.{field.name}", "string")) > 0)
        absent = F.lit(not field.required)
        checks.append(F.coalesce(F.when(value.isNull(), absent).otherwise(right), absent))
    return F.coalesce(reduce(Column.__and__, checks), F.lit(False))


def is_valid(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Whether arguments fit the schema of the tool; never for unknown tools or broken JSON."""
    cases = F.when(F.lit(False), F.lit(False))
    for tool in sorted(schemas):
        cases = cases.when(name == tool, _fits(arguments, schemas[tool]))
    return F.coalesce(cases, F.lit(False))


def canonical(fields: dict[str, Column]) -> Column:
    """One JSON object with its keys in order, no white space, and no null members."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, call_id, level)``: how many calls come before each, along ``after_id``.

    Every step lets each call look twice as far back, so a chain of n calls takes log n
    joins; a call that waits for itself has no level. Of repeated identifiers the smallest
    ``after_id`` counts, and an ``after_id`` that isn't there counts as none.
    """
    key = ["conv_id", "call_id"]
    nodes = calls.filter("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*key).agg(F.min("after_id").alias("up"))
    nodes = scratch.write(nodes)
    there = nodes.select("conv_id", F.col("call_id").alias("up"), F.lit(1).cast("long").alias("level"))
    state = scratch.write(
        nodes.join(there, ["conv_id", "up"], "left").select(
            *key, F.when(F.col("level").isNotNull(), F.col("up")).alias("up"), F.coalesce("level", F.lit(0)).alias("level")
        )
    )
    waiting, reach = state.filter("up IS NOT NULL").count(), 1
    while waiting and reach <= 2 * waiting:
        before = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        state = scratch.write(
            state.join(before, ["conv_id", "up"], "left").select(
                *key, F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")
            )
        )
        left, reach = state.filter("up IS NOT NULL").count(), reach * 2
        if left == 0:
            break
        waiting = max(waiting, left)
    return state.select(*key, F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """``(conv_id, call_id, level, linked, valid, message)``, a row for each call, and one for
    each identifier that has results only.

    ``calls`` has conv_id, call_id, after_id, name and arguments (JSON text); ``results``
    has conv_id, call_id and content. A call meets the result with its identifier in its
    conversation. Several results with one identifier are a sorted array of their contents;
    results without a call are a message without name and arguments, neither linked nor
    valid. ``level`` orders a conversation's calls so that each comes after the one it
    waits for. ``message`` is canonical JSON; arguments that are no JSON are left out.

    A call without conv_id or call_id keeps a row, without level and result. Repeated calls
    keep a row each. Other columns are ignored. Empty tables give an empty result. Rows are
    never gathered by conversation, so a long conversation is no task of its own.
    """
    scratch = Scratch(calls)
    key = ["conv_id", "call_id"]
    calls = calls.select(*key, "after_id", "name", "arguments")
    texts = F.array_sort(F.collect_list("content"))
    one = F.when(F.size("contents") == 1, F.get("contents", F.lit(0)).cast("variant"))
    several = F.when(F.size("contents") > 1, F.to_variant_object("contents"))
    found = results.groupBy(*key).agg(texts.alias("contents"), F.lit(True).alias("linked"))
    found = found.select(*key, F.coalesce(one, several).alias("content"), "linked")
    ordered = levels(calls, scratch)
    joined = calls.withColumn("called", F.lit(True)).join(found, key, "full").join(ordered, key, "left")
    called = F.col("called").isNotNull()
    message = canonical(
        {
            "arguments": F.try_parse_json("arguments"),
            "id": F.concat_ws(":", "conv_id", "call_id"),
            "name": F.col("name"),
            "result": F.col("content"),
        }
    )
    return joined.select(
        *key,
        "level",
        (called & F.coalesce("linked", F.lit(False))).alias("linked"),
        (called & is_valid(F.col("name"), F.col("arguments"), schemas)).alias("valid"),
        message.alias("message"),
    )


CHAT_SCHEMAS: Schemas = {"system": (Field("text"),), "user": (Field("text"),)}


def linked_conversations(turns: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as calls and results: what is said to the assistant
    is a call named by its role, identified by its turn; the assistant's next turn is the
    result, and a call waits for the one two turns before."""
    turn = F.col("turn").cast("long")
    mine = F.col("role").eqNullSafe("assistant")
    said = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), "role", "text")
    calls = said.filter(~mine).select(
        "conv_id",
        F.col("turn").alias("call_id"),
        (F.col("turn") - 2).alias("after_id"),
        F.col("role").alias("name"),
        F.to_json(F.struct("text")).alias("arguments"),
    )
    results = said.filter(mine).select("conv_id", (F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return link_calls(calls, results, CHAT_SCHEMAS)
