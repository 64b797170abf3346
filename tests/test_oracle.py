"""Every test query against its SQL twin on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from tagloom.queries.catalog import QUERIES
from tagloom.queries.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def normal(rows, order):
    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 6)
        return value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    found = [tuple(row) for row in frame.collect()]
    described = duck.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()
    assert {row[0]: row[1] for row in described} == {c: SQL_TYPES[t] for c, t in frame.dtypes}
    cursor = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = cursor.fetchall()
    got = normal(found, [frame.columns.index(c) for c in columns])
    assert got == normal(expected, [names.index(c) for c in columns])
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_tags_each_user_once(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows
    assert len({row["userId"] for row in rows}) == len(rows)


def test_every_score_occurs_with_bands_from_the_data(spark):
    rows = QUERIES["rfe_scores_quantile"](spark, SF_DIR).collect()
    for column in ("recency", "frequency", "engagements"):
        assert {r[column] for r in rows} == {1, 2, 3, 4, 5}


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["userId", "tagsId"]
    assert frame.count() > 0
