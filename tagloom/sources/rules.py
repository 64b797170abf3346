"""The tag rule table: definitions (level 4) and their values (level 5)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.rule_text import parse_rule

RULE_COLUMNS = ("id", "pid", "rule")

# A rule table within both bounds is copied to the driver once and may be broadcast.
# Anything larger stays distributed, and the match operators join it by shuffle.
MAX_LOCAL_RULES = 10_000
MAX_LOCAL_RULE_BYTES = 8 << 20


class MissingRule(LookupError):
    """No definition row with the wanted tag id."""


class MalformedRule(ValueError):
    """A definition holds a pair without ``=``."""


def read_rules(spark: SparkSession, source_format: str, path: str | None = None, **options):
    """The rule table from any Spark source: ``jdbc`` with url, dbtable, user and password;
    ``parquet`` and other file formats with a path."""
    reader = spark.read.format(source_format).options(**options)
    return conform_rules(reader.load(path) if path else reader.load())


def conform_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.col("id").cast("int"), F.col("pid").cast("int"), F.col("rule").cast("string")
    )


def rows_if_small(frame: DataFrame) -> list | None:
    """All rows of ``(id, ..., rule)``, or None when they are over the local bounds."""
    sizes = frame.limit(MAX_LOCAL_RULES + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("rule")).alias("bytes")
    )
    size = sizes.first()
    if size["rows"] > MAX_LOCAL_RULES or (size["bytes"] or 0) > MAX_LOCAL_RULE_BYTES:
        return None
    # The bound holds for what is collected too, should the table have grown meanwhile.
    rows = frame.limit(MAX_LOCAL_RULES + 1).collect()
    return rows if len(rows) <= MAX_LOCAL_RULES else None


def nulls_first(row: tuple) -> tuple:
    """A sort key for (id, rule) rows with nulls in either."""
    id_, rule = row[0], row[1]
    return id_ is not None, id_ or 0, rule is not None, rule or ""


@dataclass(frozen=True)
class TagValues:
    """Level-5 rows ``(id, rule)`` of one tag.

    ``rows`` holds them on the driver when they are proven to be within the local bounds,
    so that they may be broadcast or turned into expressions; it is None otherwise.
    """

    frame: DataFrame
    rows: tuple | None

    @property
    def small(self) -> bool:
        return self.rows is not None

    @classmethod
    def of(cls, frame: DataFrame) -> TagValues:
        """Wrap a frame of unknown size, checking it."""
        frame = frame.select(F.col("id").cast("int"), F.col("rule").cast("string"))
        rows = rows_if_small(frame)
        if rows is None:
            return cls(frame, None)
        return cls.local(frame.sparkSession, rows)

    @classmethod
    def local(cls, spark: SparkSession, rows: Iterable[tuple[int, str | None]]) -> TagValues:
        rows = tuple(sorted(((row[0], row[1]) for row in rows), key=nulls_first))
        return cls(local_frame(spark, rows, ("id", pa.int32()), ("rule", pa.string())), rows)

    def ids_by_rule(self) -> DataFrame:
        """``(key, value)``: each rule text with the highest id that has it."""
        if self.small:
            pairs = {rule: id_ if id_ is None else str(id_) for id_, rule in self.rows if rule is not None}
            columns = ("key", pa.string()), ("value", pa.string())
            return local_frame(self.frame.sparkSession, pairs.items(), *columns)
        return (
            self.frame.filter(F.col("rule").isNotNull())
            .groupBy(F.col("rule").alias("key"))
            .agg(F.max("id").cast("string").alias("value"))
        )


def local_frame(spark: SparkSession, rows: Iterable[tuple], *columns: tuple) -> DataFrame:
    """Frame of a few driver rows, planned as a local relation with exact statistics."""
    rows = list(rows)
    arrays = [pa.array([row[i] for row in rows], type_) for i, (_, type_) in enumerate(columns)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in columns]))


class RuleBook:
    """Lookups in the rule table. A small table is read once; a large one stays a frame."""

    def __init__(self, rules: DataFrame):
        self.rules = conform_rules(rules)
        self.spark = rules.sparkSession

    @cached_property
    def _rows(self) -> list | None:
        return rows_if_small(self.rules)

    @cached_property
    def _frame(self) -> DataFrame:
        """The rules, from the driver copy when there is one."""
        if self._rows is None:
            return self.rules
        types = pa.int32(), pa.int32(), pa.string()
        return local_frame(self.spark, self._rows, *zip(RULE_COLUMNS, types))

    def rule_for(self, level4_id: int) -> dict[str, str]:
        """Parsed definition of a tag."""
        return self.rules_for([level4_id])[level4_id]

    def rules_for(self, level4_ids: Sequence[int]) -> dict[int, dict[str, str]]:
        """Parsed definitions of several tags, from one read."""
        parsed = (
            self._frame.filter(F.col("id").isin(list(level4_ids)))
            .select("id", "rule", parse_rule(F.col("rule")).alias("pairs"))
            .collect()
        )
        found = {}
        for row in parsed:
            if row["pairs"] is None or None in row["pairs"].values():
                raise MalformedRule(
                    f"rule of tag {row['id']} has a pair without '=': {row['rule']!r}"
                )
            found.setdefault(row["id"], row["pairs"])
        for level4_id in level4_ids:
            if level4_id not in found:
                raise MissingRule(f"no rule row with id {level4_id}")
        return found

    def values_for(self, level4_id: int) -> TagValues:
        """Level-5 rows of a tag."""
        if self._rows is None:
            return TagValues.of(self.rules.filter(F.col("pid") == level4_id))
        rows = [(row["id"], row["rule"]) for row in self._rows if row["pid"] == level4_id]
        return TagValues.local(self.spark, rows)
