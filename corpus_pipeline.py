"""A corpus pipeline: each stage reads what the one before it kept."""

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import (
    op1_quality,
    op2_suffix_dedup,
    op5_simhash,
    op6_decontaminate,
    op8_sentencepiece,
)
from chatloom.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return op1_quality.reject(spark, docs, sf_dir)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return op5_simhash.keep_first(spark, docs, sf_dir)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that stand earlier in the corpus."""
    return op2_suffix_dedup.strip_repeats(spark, docs, sf_dir)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark passages."""
    return op6_decontaminate.drop_contaminated(spark, docs, sf_dir)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left, and keeps whether decoding gives it back."""
    return op8_sentencepiece.tokenize(spark, docs, sf_dir)


STAGES = [
    ("quality", quality),
    ("near copies", near_copies),
    ("repeats", repeats),
    ("benchmarks", benchmarks),
    ("tokens", tokens),
]

#: No SQL expresses a trained classifier or a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
