"""The corpus queries over the sf0.01 tables: against SQL, and the pipeline stage by stage."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tagloom.llm.oracle import ORACLE_SQL
from tagloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)

    def normal(rows):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)

    wanted = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert normal(map(tuple, frame.select(*columns).collect())) == normal(wanted) != []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "near dedup", "source mixing", "best-fit packing"
    ]
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == names
    held = {}
    for r in packed:
        held[r["sequence_id"]] = held.get(r["sequence_id"], 0) + r["length"]
    assert packed and max(held.values()) <= 4096
