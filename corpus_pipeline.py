"""A corpus clean-up pipeline over ``documents``: each stage's rows are written as Parquet in the
shared scratch folder and read again as the next stage's documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshore.llm import bpe, decontaminate, neardup, quality, suffix
from lakeshore.llm.common import scratch_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id stays."""
    return neardup.keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier are cut; every document stays."""
    return suffix.clean(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and as text what they decode to."""
    return bpe.tokenize(docs, bpe.default_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe", tokens),
]
ORACLE_SQL = None    # edit alignment, suffix buckets and BPE are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
