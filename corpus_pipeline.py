"""From raw documents to packed sequences: the stages, and their run over the table of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontaminate, packing, quality, secret_scan, simhash
from lotwise.llm.common import read, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject."""
    weights = quality.fit(docs, read(spark, sf_dir, "labels").where(~quality.is_held_out()))
    return docs.where(quality.score_of(F.col("text"), weights) >= quality.THRESHOLD)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't contaminated with benchmark items."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they are in."""
    return packing.pack_texts(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_per_group),
    ("benchmark_decontamination", without_benchmarks),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed),
]

# Trained weights, redaction by guess costs and greedy packing have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each one's result written as Parquet and reread as the next one's documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
