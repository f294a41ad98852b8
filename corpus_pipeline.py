"""The corpus pipeline: documents in, bins of clean, distinct documents out.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it
kept, and returns a DataFrame; all but the last return the columns of ``documents``.
The stages take NULLs, empty and very long texts, ties, repeated rows, empty tables and
extra columns as their operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from florin.llm import decontamination, jaccard_join, packing, personal_data, quality
from florin.llm.shipping import ship_package
from florin.session import fresh_path, remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the corpus itself, does not reject."""
    ship_package(spark)
    return quality.accepted(docs.select(*COLUMNS))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the least doc_id."""
    ship_package(spark)
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    ship_package(spark)
    return decontamination.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    ship_package(spark)
    return personal_data.without_personal_data(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, bin_id, piece, start, length, place: every document's pieces in bins."""
    ship_package(spark)
    return packing.best_fit_packing(docs.select(*COLUMNS))


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("best_fit_packing", packing_stage),
]

# Posterior labels, components and best fit are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again.

    A stage's table goes when the next one is written; the last one stays for the caller.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
