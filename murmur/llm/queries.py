"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from murmur.llm.class_lm import score_texts
from murmur.llm.common import table
from murmur.llm.conversations import repair_damaged
from murmur.llm.decontam import benchmark_items, contaminations
from murmur.llm.licenses import scan_licenses
from murmur.llm.manifest import manifest
from murmur.llm.mil_quality import score_passages
from murmur.llm.mixing import mixed_documents
from murmur.llm.near_dup import near_duplicates
from murmur.llm.oracle import manifest_sql, substrings_sql, warc_sql
from murmur.llm.quality import score_quality
from murmur.llm.secrets import scan_secrets
from murmur.llm.substrings import remove_repeats
from murmur.llm.toxicity import score_toxicity
from murmur.llm.warc import archive_round_trip


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = benchmark_items(table(spark, sf_dir, "benchmark"))
    return contaminations(table(spark, sf_dir, "documents"), items)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_mixing": op2_mixing,
        "op3_licenses": op3_licenses,
        "op4_substrings": op4_substrings,
        "op5_class_lm": op5_class_lm,
        "op6_toxicity": op6_toxicity,
        "op7_decontamination": op7_decontamination,
        "op8_secrets": op8_secrets,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_quality": op10_quality,
        "op11_manifest": op11_manifest,
        "op12_conversations": op12_conversations,
        "op13_mil_quality": op13_mil_quality,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op1_warc": warc_sql(),
        "op4_substrings": substrings_sql(),
        "op11_manifest": manifest_sql(),
    }
