"""The registered queries of the training-data operators: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bestfit, bloom_lm, chat, decontam, host_rules, importance, kd_shards, pu_quality, simhash_ring, source_audit, trie_counts, warc_chain, window_packing
from tidemark.llm.common import bounded_batches, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality_report(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pu_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return bloom_lm.scored(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return chat.digests(chat.with_probe(spark, table(spark, sf_dir, "conversations")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.sharded(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return bestfit.packed(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chain.round_trip(table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return trie_counts.counted(table(spark, sf_dir, "documents"))


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return window_packing.packed(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return source_audit.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_decontamination": op4_decontamination,
    "op5_chat": op5_chat,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_warc": op9_warc,
    "op10_token_counts": op10_token_counts,
    "op11_window_packing": op11_window_packing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_source_divergence": op13_source_divergence,
}
