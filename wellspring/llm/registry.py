"""The subpackage's queries and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import bpe, language, mixing, ngram_join, pii, quality_model, quality_rules, topk, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": ngram_join.query,
        "op2_language": language.query,
        "op3_toxicity": toxicity.query,
        "op4_pii": pii.query,
        "op5_mixing": mixing.query,
        "op6_byte_bpe": bpe.query,
        "op7_quality_rules": quality_rules.query,
        "op8_quality_model": quality_model.query,
        "op9_topk": topk.query,
        "op10_url_filter": url_filter.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_quality_rules": quality_rules.ORACLE_SQL,
        "op9_topk": topk.ORACLE_SQL,
        "op10_url_filter": url_filter.ORACLE_SQL,
    }
