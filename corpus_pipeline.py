"""A training-corpus pipeline of five of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nightledger.llm import bpe, decontaminate, near_dup, pii, quality
from nightledger.llm.common import documents, written
from nightledger.llm.queries import bpe_digests, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filter_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return near_dup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced."""
    return pii.redact(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of every document's ids and of the text they decode to."""
    return bpe_digests(bpe.encode_documents(docs, vocabulary_path()))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_redaction", pii_redaction),
    ("bpe_encoding", bpe_encoding),
]

# SQL cannot express the histogram references, component search, trained trees and token merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
