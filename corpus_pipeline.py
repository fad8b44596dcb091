"""The corpus pipeline: documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obslake.llm.common import staged
from obslake.llm.language import known_language
from obslake.llm.neardup import deduplicated
from obslake.llm.packing import packed_documents
from obslake.llm.quality import good_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that classifiers learned from `labels` take for good ones."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in one of the languages that labelled documents teach."""
    return known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return deduplicated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document in sequences of the packing operator's capacity."""
    return packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: SQL expresses neither the trained stages nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
