"""One query per corpus operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.chosen_path import near_duplicates
from tagloom.llm.collocations import collocations
from tagloom.llm.contamination import contamination_digest
from tagloom.llm.disclosure import personal_data
from tagloom.llm.gam import quality_scores
from tagloom.llm.hnsw import nearest
from tagloom.llm.lines import line_dedup_digest
from tagloom.llm.mixing import Target, mixed_sources
from tagloom.llm.packing import pack
from tagloom.llm.repair import repair_digest
from tagloom.llm.search import search
from tagloom.llm.tool_calls import linked_conversations
from tagloom.llm.wavelet import token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sources(_table(spark, sf_dir, "documents"), Target(entropy=0.99))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_conversations(_table(spark, sf_dir, "conversations"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(_table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(_table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_near_dedup,
        op3_source_mixing,
        op4_quality,
        op5_tool_calls,
        op6_token_files,
        op7_packing,
        op8_search,
        op9_line_dedup,
        op10_nearest,
        op11_conversation_repair,
        op12_decontamination,
        op13_collocations,
    )
}
