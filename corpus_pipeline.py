"""A training corpus from raw documents: the steps between a crawl and a tokenizer.

Every stage takes (spark, docs, sf_dir), calls one operator of ``shardlog.llm`` and is
written and read again before the next. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlog.llm import decontamination, line_crf, line_dedup, segmentation, simhash
from shardlog.llm.common import table
from shardlog.session import store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a chain over their lines finds good."""
    model = line_crf.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return line_crf.keep_good(docs, model)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without three-line passages that came before; wholly repeated ones go."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints: that of the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document: their piece ids and inclusion scores."""
    return segmentation.segmentations(docs, with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding", tokens),
]

# Fingerprints, the classifier and sampling are beyond SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
