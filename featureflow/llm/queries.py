"""Registered queries of the training-data operators (whole tables, production parameters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import html, langid, licenses, lm, mixing, quality, spelling, substring, topk, warc
from featureflow.llm.common import crc_mod, table
from featureflow.llm.decontaminate import contained_items
from featureflow.llm.filter_audit import filter_interactions
from featureflow.llm.minhash import near_duplicates
from featureflow.llm.oracle import ORACLE_SQL  # noqa: F401 - registered with the queries
from featureflow.session import shared_path


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html.main_text(pages, html.train(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"), window=35).withColumnRenamed("id", "doc_id")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10, scale=1024.0)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op6_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), entropy=0.95).withColumnRenamed("id", "doc_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, crc_mod("doc_id", 5) != 0)
    return langid.predict(docs, model).select(
        F.col("id").alias("doc_id"), F.coalesce(crc_mod("id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred",
        "score", "rejected")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2).withColumnRenamed("id", "doc_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                    "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), noise=97))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_mixing_sources": op6_mixing_sources,
    "op7_language_id": op7_language_id,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_warc": op10_warc,
    "op11_filter_audit": op11_filter_audit,
    "op12_license_scan": op12_license_scan,
    "op13_spelling_variants": op13_spelling_variants,
}
