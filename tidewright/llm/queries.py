"""One query per operator, on the whole table it is meant for, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import alignment, collocations, decontaminate, fingerprints, language_id, license_scan, lm_score, pieces, quality_model, quality_rules, secret_scan, simhash, token_files
from tidewright.llm.base import documents
from tidewright.llm.oracle import ORACLE


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text: pattern spans and entropy spans."""
    return secret_scan.secret_scan(documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every whole text, read back."""
    return token_files.token_files(documents(spark, sf_dir))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-unigram base score and subword lattice score of every whole text."""
    return lm_score.lm_score(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every whole text, learned from the labels of four of five folds."""
    return quality_model.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from two of three folds."""
    return language_id.language_id(documents(spark, sf_dir))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole text, as digests."""
    return pieces.piece_digest(documents(spark, sf_dir))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the place and similarity of the best window."""
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every whole text, and the smallest id that near fingerprints reach."""
    return simhash.near_dedup(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, own verdict and the verdict with that of the host, for every document."""
    return quality_rules.quality_rules(documents(spark, sf_dir))


def rules_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules with the length of a document, in steps, as its host: those of the shortest ones fail."""
    length = F.concat(F.lit("len-"), F.least(F.floor(F.col("n_chars") / 40), F.lit(50)).cast("string"))
    return quality_rules.quality_rules(documents(spark, sf_dir).withColumn("source", length))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices held by documents."""
    return license_scan.license_scan(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every whole text, with corpus-wide counts of the links."""
    return alignment.token_alignment(documents(spark, sf_dir))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of every whole text and of its edited text, with their likeness, and that to the next document."""
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two or three words in each language."""
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_token_files,
        op3_lm_score,
        op4_quality_classifier,
        op5_language_id,
        op6_sentencepiece,
        op7_decontaminate,
        op8_simhash_dedup,
        op9_quality_rules,
        rules_by_length,
        op10_license_scan,
        op11_token_alignment,
        op12_document_fingerprints,
        op13_collocations,
    )
}
