"""The queries opN_<name> with production parameters, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, divergence, hard_negatives, langid, lm_ctw, mixing, quality_mil, quality_rules, simhash, substring_dedup, toxicity, warc
from .common import table


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.result(table(spark, sf_dir, "conversations"))


def op8_lm_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_ctw.score(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.result(table(spark, sf_dir, "documents"))


def op2_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_mil": op2_quality_mil,
    "op3_simhash": op3_simhash,
    "op4_langid": op4_langid,
    "op5_warc": op5_warc,
    "op6_decontaminate": op6_decontaminate,
    "op7_chat": op7_chat,
    "op8_lm_ctw": op8_lm_ctw,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": op10_mixing,
    "op11_toxicity": op11_toxicity,
    "op12_source_divergence": op12_source_divergence,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op5_warc": warc.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op7_chat": chat.ORACLE,
    "op9_quality_rules": quality_rules.oracle(),
    "op10_mixing": mixing.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
