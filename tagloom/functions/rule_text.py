"""Rule text: ``key=value`` pairs of a tag definition and ``start-end`` ranges of its values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rule format.
PAIR_SEPARATOR = "##"
KEY_SEPARATOR = "="
RANGE_SEPARATOR = "-"


def parse_rule(rule: Column) -> Column:
    """``k=v##k=v`` as a map.

    Each pair is split at its first ``=``, so a value may itself contain one. The last of
    several pairs with one key wins, under any ``spark.sql.mapKeyDedupPolicy``. A pair
    without ``=`` gets a null value; ``RuleBook.rule_for`` turns that into an error.
    """

    def pair(piece: Column) -> Column:
        at = F.instr(piece, KEY_SEPARATOR)
        value = F.when(at > 0, F.substr(piece, at + F.lit(1)))
        return F.struct(
            F.substring_index(piece, KEY_SEPARATOR, 1).alias("key"), value.alias("value")
        )

    def last_of_each_key(pairs: Column) -> Column:
        return F.filter(
            pairs,
            lambda pair, i: ~F.exists(
                F.slice(pairs, i + F.lit(2), F.size(pairs)),
                lambda later: later["key"] == pair["key"],
            ),
        )

    # The one-element array binds the pairs to a variable, so they are built once per rule.
    pairs = F.array(F.transform(F.split(rule, PAIR_SEPARATOR), pair))
    return F.get(F.transform(pairs, lambda p: F.map_from_entries(last_of_each_key(p))), F.lit(0))


def range_bounds(rule: Column, numeric: bool = False) -> tuple[Column, Column]:
    """First and second piece of ``start-end``; null where missing or, if numeric, unreadable.

    Negative bounds are not part of the format: ``-5-0`` reads as a missing start and 5.
    """
    pieces = F.split(rule, RANGE_SEPARATOR)
    bounds = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
    return tuple(b.try_cast("bigint") for b in bounds) if numeric else bounds
