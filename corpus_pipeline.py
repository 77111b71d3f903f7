"""The training-data pipeline over `documents`: five stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
documents; the last returns them with `repetition`, one row per repetition in the mix.
Null texts are empty texts: the first stage judges them, at most one passes the second.
Rows that repeat in doc_id and text are copies of each other. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, exact_dedup, mixing, quality, simhash
from tallyframe.llm.common import bounded_batches, table
from tallyframe.session import scratch_path, scratch_scope


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    bounded_batches(spark)
    return quality.apply(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id stays."""
    bounded_batches(spark)
    return exact_dedup.apply(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the one with the smallest doc_id stays."""
    bounded_batches(spark)
    return simhash.apply(docs, shingle=3, radius=2)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    bounded_batches(spark)
    return decontaminate.apply(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.apply(docs)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("decontamination", benchmark_passages),
    ("mixing", mix),
]

#: A trained classifier and XXH64 fingerprints have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the whole documents table; what a stage stored on its way goes with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
