"""The corpus pipeline: from raw documents to a mixed training set, a table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from occspark.llm import decontaminate, langid, mixing, secrets, simhash
from occspark.llm.store import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language is not found with a probability of 0.5."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest identifier of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain 0.8 or more of a benchmark item's 5-word shingles."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and replaces the secrets in its text by their kind."""
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws as many tokens as there are so that they meet the tempered source, language and topic margins.

    Documents of rare cells come repeatedly.
    """
    return mixing.sample(docs, budget=1.0)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixture", mixture),
]

#: Neither the trained model nor the fitted weights can be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
