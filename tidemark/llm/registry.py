"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import (
    best_fit,
    chat,
    exact_dedup,
    hard_negatives,
    nearest,
    ngram_join,
    packing,
    paragraph_dedup,
    pieces,
    quality,
    resampling,
    sharding,
    suffix_dedup,
)
from tidemark.llm.common import table
from tidemark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies ``operator`` to a whole table."""
    return lambda spark, sf_dir: operator(table(prepare(spark), sf_dir, name))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_chat_formatting": on("conversations", chat.digest),
        "op2_ngram_jaccard_join": on("documents", ngram_join.digest),
        "op3_sentencepiece": on("documents", pieces.digest),
        "op4_quality_classifier": _scores,
        "op5_paragraph_dedup": on("documents", paragraph_dedup.report),
        "op6_suffix_dedup": on("documents", suffix_dedup.digest),
        "op7_exact_dedup": on("documents", exact_dedup.decisions),
        "op8_packing": on("documents", packing.pack),
        "op9_nearest_neighbours": on("embeddings", nearest.digest),
        "op10_sharding": on("documents", sharding.shards),
        "op11_hard_negatives": on("embeddings", hard_negatives.hard_negatives),
        "op12_importance_resampling": _resampled,
        "op13_best_fit_packing": on("documents", best_fit.pack),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": chat.ORACLE,
        "op7_exact_dedup": exact_dedup.ORACLE,
        "op10_sharding": sharding.ORACLE,
        "op11_hard_negatives": hard_negatives.ORACLE,
    }
