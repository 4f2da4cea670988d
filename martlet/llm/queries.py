"""The queries of this subpackage and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import (
    chat_format,
    license_rules,
    line_templates,
    merkle_manifest,
    mixing,
    ngram_join,
    periodic_runs,
    repetition,
    sentencepiece_sampling,
    simhash,
    url_rules,
    warc_store,
    window_dedup,
)
from martlet.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_gumbel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_sampling.sample_digests(_table(spark, sf_dir, "documents"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc_store.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc_store.parse_records(warc_store.read_archive(spark, path))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.summary(_table(spark, sf_dir, "documents"))


def op4_mixture_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_plan(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), url_rules.base_rules(spark))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_and_link(_table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_table(spark, sf_dir, "documents"))


def op9_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge_documents(_table(spark, sf_dir, "documents")).drop("longest_repeat")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat_format.with_marked_conversation(_table(spark, sf_dir, "conversations"))
    return chat_format.conversation_digests(chat_format.format_records(chat_format.pack_records(conversations)))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(merkle_manifest.document_leaves(_table(spark, sf_dir, "documents"), tamper=True))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.plant_periods(_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece_gumbel": op1_sentencepiece_gumbel,
    "op2_warc_archive": op2_warc_archive,
    "op3_line_templates": op3_line_templates,
    "op4_mixture_budget": op4_mixture_budget,
    "op5_license_scan": op5_license_scan,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_ngram_join": op8_ngram_join,
    "op9_repetition_quality": op9_repetition_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_warc_archive": warc_store.ORACLE,
    "op4_mixture_budget": mixing.ORACLE,
    "op6_url_filter": url_rules.ORACLE,
    "op9_repetition_quality": repetition.ORACLE,
    "op11_chat_format": chat_format.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
}
