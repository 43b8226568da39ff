"""From raw documents to token ids, stage by stage; every stage reads the files that the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablework.llm import bpe, common, cotrain, decontam, pii, simhash


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return cotrain.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Documents whose sets of five-word shingles are similar by 0.8 or more are near duplicates.
    """
    return simhash.keep_one(docs, size=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return pii.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded octets, and the ids."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("byte_level_bpe", byte_bpe),
]

ORACLE_SQL = None  # a fitted model, fingerprints and token ids are beyond SQL; tests/llm compares each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
