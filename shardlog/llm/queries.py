"""One query for each operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.llm import decontamination, language_id, licenses, line_crf, line_dedup, one_permutation, phrases, segmentation, simhash, spelling, sql, suffix_dedup, topk, warc
from shardlog.llm.common import table
from shardlog.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES", "phrases", "spelling"]


@query("op1_decontamination", sql.DECONTAMINATION)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document lie in passages of benchmark items?"""
    found = decontamination.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        decontamination.item_digest(F.col("item_ids")).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents have fingerprints that few bits tell apart?"""
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_suffix_array_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which bytes of each document lie in strings of 400 bytes that occur elsewhere?"""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op10_line_dedup", sql.LINE_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the line windows that occurred before?"""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How good is each document, by a chain over its lines?"""
    docs = table(spark, sf_dir, "documents")
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.score(docs, model).select(
        F.col("id").alias("doc_id"),
        line_crf.held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "bad_lines",
    )


@query("op2_warc", sql.WARC)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What do the normalised archives of all pages hold?"""
    return warc.round_trip(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op5_exact_topk", sql.TOP_K)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which five vectors have the greatest inner products with each query vector?"""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which language is each page in, by its text, markup, address and host?"""
    model = language_id.train_text(table(spark, sf_dir, "documents"))
    return language_id.identify(table(spark, sf_dir, "pages"), model).withColumnRenamed("id", "page_id").drop("posterior")


@query("op4_license_scan", sql.LICENSE_SCAN)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which license notices does each document hold?"""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.template_table(spark)).withColumnRenamed("id", "doc_id")


@query("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which segmentations does each document get, and do they decode to it?"""
    return segmentation.segmentations(table(spark, sf_dir, "documents"), with_ids=True).withColumnRenamed("id", "doc_id")


@query("op11_document_fingerprints")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How like is each document to its edited text, and to the next document?"""
    found = one_permutation.compare_edited(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        one_permutation.hex_of(F.col("fingerprint")).alias("fingerprint"),
        one_permutation.hex_of(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
