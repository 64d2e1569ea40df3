"""Queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontaminate, jaccard, langid, licenses, packing, phrases, pii, quality, scoring, sharding, sql, substrings, suffix
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.op2_lm_scoring(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op3_packing(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op4_license_scan(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op5_sharding(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.op6_suffix_dedup(documents(spark, sf_dir))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op7_jaccard_join(documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op8_decontamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op9_pii(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op10_language_id(documents(spark, sf_dir))


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 on raw web pages: markup language, host and address suffix."""
    return langid.language_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.op11_collocations(documents(spark, sf_dir))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.op12_substring_dedup(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.op13_conversation_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Query]:
    found = [op1_quality_rules, op2_lm_scoring, op3_packing, op4_license_scan, op5_sharding, op6_suffix_dedup, op7_jaccard_join, op8_decontamination, op9_pii, op10_language_id, language_of_pages, op11_collocations, op12_substring_dedup, op13_conversation_repair]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
