"""From raw documents to token ids in five stages; each reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hanok.llm import bpe, decontaminate, quality, queries, secrets, simhash
from hanok.llm.shared import table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def secret_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a placeholder."""
    return secrets.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and of the text decoded from them, and the ids."""
    return bpe.tokenize(docs, queries.tokenizer_source(), keep_ids=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_filter),
    ("secret scans", secret_filter),
    ("BPE encoding and decoding", token_ids),
]

# Trained models and token merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
