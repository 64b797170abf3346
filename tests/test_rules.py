from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagloom.functions import parse_rule, range_bounds
from tagloom.sources import MalformedRule, MissingRule, RuleBook, SourceSpec, TagValues
from tagloom.sources import read_rules, read_source, rules as rules_module

RULES = "id int, pid int, rule string"


def test_parse_rule(spark, ansi):
    rows = [(1, "a=1##b=2"), (2, "a=1##a=2"), (3, "a=1=2"), (4, "a"), (5, None), (6, "a=##b=x")]
    frame = spark.createDataFrame(rows, "n int, rule string")
    parsed = {r["n"]: r["m"] for r in frame.select("n", parse_rule(F.col("rule")).alias("m")).collect()}
    assert parsed == {
        1: {"a": "1", "b": "2"},
        2: {"a": "2"},
        3: {"a": "1=2"},
        4: {"a": None},
        5: None,
        6: {"a": "", "b": "x"},
    }


def test_range_bounds(spark, ansi):
    rows = [("0-15",), ("5",), ("x-y",), ("-5-0",), ("1-2-3",), (None,)]
    frame = spark.createDataFrame(rows, "rule string")
    lo, hi = range_bounds(F.col("rule"))
    low, high = range_bounds(F.col("rule"), numeric=True)
    assert [tuple(r) for r in frame.select(lo, hi, low, high).collect()] == [
        ("0", "15", 0, 15),
        ("5", None, 5, None),
        ("x", "y", None, None),
        ("", "5", None, 5),
        ("1", "2", 1, 2),
        (None, None, None, None),
    ]


@pytest.mark.parametrize("limit", [10_000, 2], ids=["local", "distributed"])
def test_rule_book(spark, monkeypatch, limit):
    monkeypatch.setattr(rules_module, "MAX_LOCAL_RULES", limit)
    rows = [(4, 1, "inType=es##esNodes=n"), (9, 4, "b"), (8, 4, "a"), (5, 7, "c"), (6, 1, "oops")]
    book = RuleBook(spark.createDataFrame(rows, RULES))
    assert book.rule_for(4) == {"inType": "es", "esNodes": "n"}
    values = book.values_for(4)
    assert sorted(map(tuple, values.frame.collect())) == [(8, "a"), (9, "b")]
    assert values.small
    assert book.values_for(99).frame.collect() == []
    with pytest.raises(MissingRule):
        book.rule_for(99)
    with pytest.raises(MalformedRule):
        book.rule_for(6)


def test_values_over_the_bound_stay_distributed(spark, monkeypatch):
    monkeypatch.setattr(rules_module, "MAX_LOCAL_RULES", 2)
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, rule string")
    values = TagValues.of(frame)
    assert not values.small
    assert sorted(map(tuple, values.ids_by_rule().collect())) == [("a", "1"), ("b", "3")]
    monkeypatch.setattr(rules_module, "MAX_LOCAL_RULES", 10)
    monkeypatch.setattr(rules_module, "MAX_LOCAL_RULE_BYTES", 2)
    assert not TagValues.of(frame).small


def test_local_and_distributed_values_agree_on_duplicates(spark):
    rows = [(3, "b"), (1, "a"), (2, "b"), (4, None)]
    local = TagValues.local(spark, rows).ids_by_rule()
    spread = TagValues(spark.createDataFrame(rows, "id int, rule string"), None).ids_by_rule()
    assert sorted(map(tuple, local.collect())) == sorted(map(tuple, spread.collect()))


def test_source_spec():
    assert SourceSpec.from_map({}) == SourceSpec()
    spec = SourceSpec.from_map(
        {
            "inType": "Elasticsearch",
            "esNodes": "h:9200",
            "esIndex": "users",
            "esType": "_doc",
            "selectFields": "id, gender",
            "more": "x",
        }
    )
    assert spec.format == "es" and spec.path is None
    assert spec.columns == ["id", "gender"]
    assert spec.options() == {
        "es.nodes": "h:9200",
        "es.resource": "users/_doc",
        "es.read.field.include": "id, gender",
        "es.mapping.date.rich": "false",
    }
    files = SourceSpec("Parquet", "/data/", "users", None, None)
    assert (files.format, files.path, files.options(), files.columns) == (
        "parquet",
        "/data/users",
        {},
        [],
    )


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_read_source_prunes_columns(spark, tmp_path, fmt):
    frame = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id bigint, job string, other string")
    frame.write.format(fmt).save(str(tmp_path / "users"))
    read = read_source(spark, SourceSpec(fmt, str(tmp_path), "users", None, "id,job"))
    assert sorted(map(tuple, read.collect())) == [(1, "a"), (2, "b")]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan.split("ReadSchema")[1]


def test_read_rules_from_files(spark, tmp_path):
    frame = spark.createDataFrame([(5, 4, "1", "x")], "id bigint, pid bigint, rule string, name string")
    frame.write.parquet(str(tmp_path / "rules"))
    rules = read_rules(spark, "parquet", str(tmp_path / "rules"))
    assert rules.dtypes == [("id", "int"), ("pid", "int"), ("rule", "string")]
    assert [tuple(r) for r in rules.collect()] == [(5, 4, "1")]


class FakeReader:
    """Records reader calls, since the connectors are not installed here."""

    def __init__(self, frame):
        self.frame, self.seen = frame, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self, path=None):
        self.seen["path"] = path
        return self.frame


def test_connector_reads_are_set_up(spark):
    class Session:
        pass

    session = Session()
    frame = spark.createDataFrame([(5, 4, "1")], RULES)
    session.read = FakeReader(frame)
    url = "jdbc:mysql://host/tags"
    read_rules(session, "jdbc", url=url, dbtable="tags", user="u", password="p")
    assert session.read.seen == {
        "format": "jdbc",
        "url": url,
        "dbtable": "tags",
        "user": "u",
        "password": "p",
        "path": None,
    }
    session.read = FakeReader(frame)
    read_source(session, SourceSpec("es", "h:9200", "users", "_doc", "id"))
    assert session.read.seen["format"] == "es"
    assert session.read.seen["es.resource"] == "users/_doc"


def test_nulls_and_repeats_in_small_rule_tables(spark):
    rows = [(None, "a"), (3, None), (3, "a"), (3, "a"), (None, None), (2, "b"), (None, "c")]
    values = TagValues.of(spark.createDataFrame(rows, "id int, rule string"))
    assert values.small
    large = TagValues(values.frame, None)
    found = [sorted(map(tuple, v.ids_by_rule().collect())) for v in (values, large)]
    assert found[0] == found[1] == [("a", "3"), ("b", "2"), ("c", None)]
