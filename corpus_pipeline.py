"""From raw documents to a training mix: quality rules, near-duplicates, benchmark leaks, personal data, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grainmill.llm import bagminhash, decontaminate, mixing, pii, quality
from grainmill.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id."""
    return bagminhash.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates, n_chars counted anew."""
    rows = pii.with_surrogates(docs)
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, as often as it takes them."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark leaks", benchmark_leaks),
    ("personal data", personal_data),
    ("source mix", source_mix),
]

#: Signatures and latent retrieval are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
