"""The registered queries on the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from overflight.llm import (
    chat, contexts, decontam, html, importance, langid, licenses, mixing, neardup, quality, repair, substrings, tokens,
)
from overflight.llm.common import light_reads, table
from overflight.llm.oracles import ORACLES


TOKENIZER = "byte_bpe_50k.json"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.clustered(table(spark, sf_dir, "documents"), size=3, percent=85)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contexts.scored(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    light_reads(spark)
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like the control strings of a template."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
        "AS t(conv_id, turn, role, text)")
    return chat.formatted(rows.unionByName(marks))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule on their keys."""
    return repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_mix_sources": op5_mix_sources,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_token_ids": op10_token_ids,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

__all__ = ["ORACLES", "QUERIES"]
