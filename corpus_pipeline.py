"""The corpus pipeline: STAGES, each (name, function(spark, docs, sf_dir) -> DataFrame).

Every stage works on all rows that its predecessor kept and reads them from the table written for it. All but the
last return the columns of documents. SQL cannot express the fingerprints, windows and merges of the later
stages, so ORACLE_SQL is None and the tests compare run() with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import decontaminate, pieces, quality_rules, secret_scan, simhash
from tidewright.llm.base import Scratch, documents
from tidewright.sources.scratch import used_up


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the rate of their host reject go."""
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near fingerprints the document with the smallest id stays."""
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a near copy of a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; each secret in their texts is replaced by a mask, and n_chars follows."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and hash of each text's ids, and hash of what they decode to."""
    return pieces.piece_digest(docs)


STAGES = [
    ("quality_rules", rules),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secrets),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on the written rows of the one before it."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        scratch = Scratch(spark, f"pipeline-{name}")
        with used_up():
            out = scratch.cut(stage(spark, docs, sf_dir))
        if last:
            last.drop(docs)
        docs, last = out, scratch
    return docs
