"""Corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import linededup, packing, pii, quality, simhash
from gridloom.llm.common import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts have no words and go, repeated rows stay or go alike."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go, but from its page of least doc_id; rows that lose every line go, null sources are one."""
    return linededup.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (0.8 of five-word shingles) stays, that of least doc_id; texts without a word are one group."""
    return simhash.drop_near_duplicates(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are masked; null texts stay null, other columns as they are."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids; a null or empty text is its end id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("pii", sanitise), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written and read again; an empty table gives an empty table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
