"""The test tables seen as posts and comments.

Text is projected to what a query needs *before* any join, so that the joins
shuffle titles and scores but never bodies nobody asked for.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.functions import keyword_sentiment
from murmura.operators.scoring import with_clean_text, with_sentiment
from murmura.session import tune

POSITIVE, NEGATIVE = ["with"], ["that"]


def scorer(text: Column) -> Column:
    """The words that split the invented prose of the test tables into three classes."""
    return keyword_sentiment(text, POSITIVE, NEGATIVE)


# Declared, so that opening a table runs no job to find its schema.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and in local mode with a scratch folder.

    A cluster names its shared folder itself.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not known and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="murmura-"))
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as far as the text alone tells: no time, score or author.

    A table of one file split, as the small test tables are, would be read by
    one task; its rows are dealt out so that all cores work on the texts. A
    table of more splits is read as it is.
    """
    dealt = table(spark, sf_dir, "documents")
    if dealt.select("doc_id").rdd.getNumPartitions() == 1:
        dealt = dealt.repartition(spark.sparkContext.defaultParallelism)
    raw = dealt.select(
        F.col("doc_id").alias("id"),
        F.concat_ws(" ", "source", "doc_id").alias("title"),
        F.col("text").alias("body"),
        F.col("source").alias("subreddit"),
    )
    return with_sentiment(with_clean_text(raw), scorer)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, author and time of each post."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("value").alias("score"),
        F.col("user_id").alias("author"),
        F.col("ts").alias("created_utc"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(metadata(spark, sf_dir), "id")


def with_comment_count(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("num_comments"))
    )
    joined = df.join(counts, "id", "left")
    return joined.withColumn("num_comments", F.coalesce("num_comments", F.lit(0)))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.col("conv_id"), F.col("turn")).alias("id"),
        F.col("conv_id").alias("post_id"),
        F.col("text").alias("body"),
        F.col("role").alias("author"),
        F.length("text").cast("double").alias("score"),
        F.col("turn").alias("ordinal"),
    )
    return with_sentiment(with_clean_text(raw), scorer)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded, since means of doubles depend on the order of addition.

    Rounded to 9 places first, which takes away that noise, and then to 6:
    else the noise decides where a value lies half-way between two results.
    """
    return df.select(
        [
            F.round(F.round(c, 9), 6).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )
