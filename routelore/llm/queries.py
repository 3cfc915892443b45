"""Registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_extract, langid, mixing, prefix_trie, quality, repair, secret_scan, sharding, simhash, suffix_dedup, token_counts, toxicity
from .common import read


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(spark, read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontam_query(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(spark, read(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(spark, docs, F.col("doc_id"), sharding.shard_names())


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(spark, read(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets_query(spark, read(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_query(spark, read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_query(spark, read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.tokens_query(spark, read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_query(spark, read(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_query(spark, read(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_query(spark, read(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_query(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: Every registered query.
QUERIES = [
    op1_suffix_dedup, op2_decontamination, op3_quality, op4_sharding, op5_html, op6_secrets, op7_language, op8_mixing, op9_token_counts, op10_simhash,
    op11_repair, op12_prefix_trie, op13_toxicity,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality": quality.ORACLE, "op4_sharding": sharding.oracle("doc_id"), "op8_mixing": mixing.ORACLE}
