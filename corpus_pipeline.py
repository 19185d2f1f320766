"""A corpus from raw documents to packed sequences, one written table after another.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``. A stage judges all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import decontamination, jaccard_join, packing, pu_quality, secret_scan
from pairloom.llm.queries import tokenizer
from pairloom.llm.scratch import keep, release
from pairloom.sources.tables import load_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    return pu_quality.keep_good(docs, load_dir(spark, sf_dir, "labels.parquet"))


def jaccard_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: four fifths of their five-word shingles or more."""
    return jaccard_join.keep_representatives(docs, words=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold test items to a twentieth of their words or more."""
    return decontamination.drop_contaminated(docs, load_dir(spark, sf_dir, "benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secret_scan.redact(docs)


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_redaction),
    ("packing", curve_packing),
]

#: Classifier, grammar of secrets and tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = load_dir(spark, sf_dir, "documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return docs
