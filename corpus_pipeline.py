"""From raw documents to packed training sequences, as stages that each read a table and
write the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.chosen_path import one_of_each
from tagloom.llm.gam import good_documents
from tagloom.llm.lines import without_shared_lines
from tagloom.llm.mixing import Target, mix
from tagloom.llm.packing import pack
from tagloom.llm.tables import Scratch


# No source is read more than one and a half times, and every source at least once in full.
MIXTURE = Target(repeats=1.5, passes=None)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go."""
    return without_shared_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: 0.8 on shingles of five words."""
    return one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, in part, to even out the sources; no document is lost."""
    return mix(docs, MIXTURE).select(*[f"`{c}`" for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_duplicate_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

# The classifier is fitted by boosting, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(docs)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.write(docs)
    return docs
