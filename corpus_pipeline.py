"""A training-data pipeline over ``documents``: judge, deduplicate, decontaminate, redact, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import decontaminate, packing, quality, secret_scan, simhash
from colloquy.llm.common import stored, table
from colloquy.llm.queries import word_vocabulary


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic or poor than not go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are masked; all documents stay."""
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs, word_vocabulary())


STAGES = [
    ("quality_classifier", judge), ("simhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminate_benchmark), ("secret_scans", redact), ("best_fit_packing", pack),
]

# Learned weights, alignment and subword ids are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
