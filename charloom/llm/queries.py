"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from charloom.llm.bpe import round_trip
from charloom.llm.collocations import PHRASE_SQL, collocations
from charloom.llm.common import prepare, table
from charloom.llm.conversations import repair_damaged
from charloom.llm.htmltree import extract_text
from charloom.llm.langid import language_predictions
from charloom.llm.license import scan_licenses
from charloom.llm.line_dedup import LINE_SQL, dedup_digest
from charloom.llm.packing import pack_documents
from charloom.llm.pq import embedding_components
from charloom.llm.quality import QUALITY_SQL, quality_verdicts
from charloom.llm.simhash import simhash_components
from charloom.llm.toxicity import held_out_toxicity
from charloom.llm.urlrules import PAGE_RULES, URL_SQL, judge_urls


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                          public_tokenizers.path("word_bpe_49k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents", "doc_id", "text"),
                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup_digest(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_verdicts(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("rk")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents", "doc_id", "text")).drop("rk")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), PAGE_RULES)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                             table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repair_damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return extract_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


LLM_QUERIES = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_simhash": op6_simhash,
    "op7_language_id": op7_language_id,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_html_extraction": op12_html_extraction,
    "op13_phrase_mining": op13_phrase_mining,
}

LLM_ORACLES = {
    "op3_line_dedup": LINE_SQL,
    "op4_quality_rules": QUALITY_SQL,
    "op8_url_filter": URL_SQL,
    "op13_phrase_mining": PHRASE_SQL,
}
