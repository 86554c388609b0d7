"""Queries of this package over the given tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html, jaccard, lexical, lines, mixing, oracle, pii, quality, resample, secrets, tokens, transducer, warc
from ..session import scratch_dir
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

#: SQL of the queries that SQL can express.
LLM_ORACLE: dict[str, str] = {
    "op5_ngram_join": oracle.OP5,
    "op6_warc": oracle.OP6,
    "op7_quality_rules": oracle.OP7,
    "op13_lexical_search": oracle.OP13,
}


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("ref")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_through_shards(table(spark, sf_dir, "documents"), scratch_dir(spark, "shards")).drop("source")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduplicated = lines.deduplicate_lines(table(spark, sf_dir, "documents"))
    return deduplicated.select("doc_id", "text", "n_lines", "n_removed")


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.transcode(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontaminate": op2_decontaminate,
    "op3_personal_data": op3_personal_data,
    "op4_secrets": op4_secrets,
    "op5_ngram_join": op5_ngram_join,
    "op6_warc": op6_warc,
    "op7_quality_rules": op7_quality_rules,
    "op8_source_mix": op8_source_mix,
    "op9_main_text": op9_main_text,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance_resample": op11_importance_resample,
    "op12_bpe_transducer": op12_bpe_transducer,
    "op13_lexical_search": op13_lexical_search,
}
