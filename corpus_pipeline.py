"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every stage's
result as Parquet to the shared checkpoint folder, and the next stage reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraloom.llm import exact, packing, quality, queries, simhash
from terraloom.llm.langid import keep_identified
from terraloom.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language."""
    return keep_identified(docs, queries.language_model(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for quality."""
    return quality.keep_good(docs, quality.train_quality(docs, queries.table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact.drop_exact_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup),
          ("simhash_dedup", simhash_dedup), ("packing", pack)]

ORACLE_SQL = None  # the stages' models have no SQL form; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
