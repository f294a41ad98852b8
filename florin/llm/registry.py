"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from florin.llm import (
    decontamination,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    packing,
    personal_data,
    quality,
    sharding,
    token_counts,
    url_filter,
    whitening,
)
from florin.llm.oracles import ORACLES as ORACLES
from florin.llm.shipping import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    return query


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontamination.decontamination(documents, benchmark)


QUERIES: dict[str, Query] = {
    "op1_language_id": _over("documents", language_id.language_id),
    "op2_personal_data": _over("documents", personal_data.personal_data),
    "op3_document_fingerprints": _over("documents", fingerprints.document_fingerprints),
    "op4_ngram_jaccard": _over("documents", jaccard_join.ngram_jaccard),
    "op6_decontamination": _decontamination,
    "op5_best_fit_packing": _over("documents", packing.best_fit_packing),
    "op7_token_counts": _over("documents", token_counts.token_counts),
    "op8_url_filter": _over("pages", url_filter.url_filter),
    "op9_sharding": _over("documents", sharding.sharding),
    "op10_quality_classifier": _over("documents", quality.quality_classifier),
    "op11_license_scan": _over("documents", license_scan.license_scan),
    "op12_embedding_whitening": _over("embeddings", whitening.embedding_whitening),
    "op13_hard_negatives": _over("embeddings", hard_negatives.hard_negatives),
    "pipeline": corpus_pipeline.run,
}
