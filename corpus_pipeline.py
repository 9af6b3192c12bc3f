"""A corpus from raw documents to packed token windows, stage by stage.

Each stage takes all that its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, ngram_join, packing, quality, suffix_dedup
from tidemark.llm.common import table
from tidemark.session import prepare, scratch, temporary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (learned from ``labels``) does not reject."""
    return quality.keep_good(docs, table(prepare(spark), sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group equal but for white space: the longest, then least id."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each component of documents linked by Jaccard similarity."""
    return ngram_join.keep_one(docs)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat an earlier 100-byte string; n_chars counted anew."""
    return suffix_dedup.cut_texts(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("suffix-array dedup", suffixes),
    ("packing", packed),
]

#: The classifier and the packing have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each one returns is written as Parquet and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
