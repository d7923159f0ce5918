"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiscope.llm import (decontaminate, html_text, interpolated_lm, licenses, mixing, near_duplicates, pii, quality,
                            secrets, spelling, token_alignment, url_filter, warc)
from sentiscope.llm.common import scan


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality.judge(scan(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates.near_duplicate_classes(docs).select("doc_id", "class_id", "class_size")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(scan(spark, sf_dir, "documents", "doc_id", "text"),
                                        scan(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents", "doc_id", "text")
    return pii.replace_personal_data(docs).select("doc_id", "n_entities", "text")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.find_licenses(docs, licenses.known_digests(spark))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_documents(scan(spark, sf_dir, "documents", "doc_id", "text"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = scan(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(scan(spark, sf_dir, "documents", "doc_id", "text")))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(scan(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.spelling_forms(spelling.vocabulary(spelling.with_slips(spelling.word_runs(docs))))


def op12_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(scan(spark, sf_dir, "pages", "page_id", "url", "html"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_scores(scan(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_quality_rules, op3_near_duplicates, op4_decontaminate, op5_surrogates, op6_license_scan,
    op7_lm_scores, op8_url_filter, op9_secret_scan, op10_main_text, op11_spelling_variants, op12_warc_round_trip,
    op13_token_alignment)}

ORACLES = {
    "op1_mix_sources": mixing.MIX_SQL,
    "op2_quality_rules": quality.QUALITY_SQL,
    "op8_url_filter": url_filter.URL_SQL,
    "op11_spelling_variants": spelling.SPELLING_SQL,
    "op12_warc_round_trip": warc.WARC_SQL,
}
