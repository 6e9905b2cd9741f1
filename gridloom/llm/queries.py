"""Queries op1..op10 over the synthetic tables, and their DuckDB SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact, linededup, packing, pii, quality, simhash, tokencount, toxicity, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document: a null text counts as empty, repeated rows each get a row, an empty table gives none."""
    return pii.report(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of equal texts: null text equals empty; of rows that repeat a doc_id, one stays."""
    return exact.report(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of sequences: a null or empty text is its end id alone, repeated rows are documents of their own."""
    return packing.report(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from each document: null hosts are one host, null text is one blank line, repeated rows are pages of their own."""
    return linededup.report(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document: null text has no words and fails, repeated rows each get a row."""
    return quality.report(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document and what they decode to: null text has none, repeated rows each get a row."""
    return bpe.report(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document: null text has none, repeated rows each get a row."""
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document: texts without a word have fingerprint zero, repeated rows each get a row."""
    return simhash.report(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document: an empty or null text scores as one without letters, a null doc_id is held out of nothing."""
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of each page's list at its fetch time: pages without URL or host match nothing and stay."""
    return urlfilter.report(spark, _table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_pii, op2_exact_dedup, op3_packing, op4_line_dedup, op5_quality, op6_byte_bpe, op7_token_counts, op8_simhash, op9_toxicity, op10_url_filter)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact.ORACLE_SQL, "op4_line_dedup": linededup.ORACLE_SQL, "op5_quality": quality.oracle_sql(), "op10_url_filter": urlfilter.ORACLE_SQL}
