"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arkspark.llm.chat_format import chat_digest, format_chats
from arkspark.llm.common import table
from arkspark.llm.decontaminate import contaminated
from arkspark.llm.embedding_dedup import embedding_near_duplicates
from arkspark.llm.filter_audit import filter_audit
from arkspark.llm.html_extract import extract_main_text
from arkspark.llm.ngram_join import ngram_jaccard_join
from arkspark.llm.oracles import CHAT_FORMATTING, FILTER_AUDIT, NGRAM_JOIN, QUALITY_RULES, WARC
from arkspark.llm.pairwise_quality import fit_quality, quality_report
from arkspark.llm.periodic_runs import periodic_runs, runs_digest, with_planted_runs
from arkspark.llm.quality_rules import quality_rules
from arkspark.llm.source_mix import mix_sources
from arkspark.llm.token_counts import length_histogram, limit_report
from arkspark.llm.toxicity import toxicity_report
from arkspark.llm.warc_zstd import archive_round_trip


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat_digest(format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))).drop("roundtrip")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "frequent_lines", "left_words", "left_text")


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix_sources(docs, fit_quality(docs, table(spark, sf_dir, "labels"))).drop("source")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_report(length_histogram(table(spark, sf_dir, "documents")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_digest(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_toxicity, op3_chat_formatting, op4_quality_rules, op5_mixing_sources, op6_token_counts, op7_html_extraction, op8_quality_classifier, op9_benchmark_decontamination, op10_warc, op11_periodic_runs, op12_embedding_near_dedup, op13_filter_audit)}


#: The other queries rest on models, tokenizers or drawn keys.
ORACLE_SQL: dict[str, str] = {"op1_ngram_jaccard_join": NGRAM_JOIN, "op3_chat_formatting": CHAT_FORMATTING, "op4_quality_rules": QUALITY_RULES, "op10_warc": WARC, "op13_filter_audit": FILTER_AUDIT}
