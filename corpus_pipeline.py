"""A training corpus out of raw documents, stage by stage.

Each stage takes the documents its predecessor kept and returns the documents
it keeps, with the same columns; the last returns the mix. ``run`` writes
every stage's result to the shared scratch folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.bindings import prepared
from murmura.llm import decontamination, mixing, near_dedup, quality_classifier, secret_scan
from murmura.llm.queries import benchmark, documents, labels
from murmura.llm.text import fresh_name
from murmura.sources.scratch import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    known = labels(prepared(spark), sf_dir).select("doc_id", F.col("quality").alias("label"))
    return quality_classifier.good_documents(docs, known).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    prepared(spark)
    return near_dedup.deduplicated(docs).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no notable share of benchmark passages."""
    return decontamination.decontaminated(docs, benchmark(prepared(spark), sf_dir)).select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    prepared(spark)
    spans = fresh_name(docs, "secrets")
    found = secret_scan.secrets(docs, name=spans)
    masked = secret_scan.redacted(F.col("text"), F.col(spans))
    size = F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("text", masked).withColumn("n_chars", size).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in order: a row per copy taken, with its words that belong to the mix."""
    prepared(spark)
    mix = mixing.mixture(mixing.fair_queue(docs))
    columns = ["doc_id", "source", "size", "target", "copy", "finish", "words", "text"]
    return mixing.mixed_texts(docs, mix).select(columns)


STAGES = [
    ("quality_classifier", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
]

# A classifier that is trained on the way has no SQL; tests compare small fixtures with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of a folder."""
    docs = documents(prepared(spark), sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
