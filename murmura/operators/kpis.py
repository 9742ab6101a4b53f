"""Counts and means over posts: the whole table and per group.

All of these aggregate before they shuffle, so a group with a large share of
the rows sends one partial row per task like any other group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.functions import is_negative, is_neutral, is_positive, number


STATS_VALUES = ("score", "sentiment", "num_comments")


def _rows() -> Column:
    return F.count(F.lit(1))


def _mean(df: DataFrame, name: str) -> Column:
    """Mean of a column, NULL when the table lacks it."""
    return F.avg(number(df, name)) if name in df.columns else F.lit(None).cast("double")


def group_stats(df: DataFrame, by: str = "subreddit", plain_names: bool = True) -> DataFrame:
    """Mean score, sentiment and comment count per group. A NULL group is kept.

    ``plain_names=False`` names the columns ``avg(score)`` and so on, for
    readers that quote Spark's generated names.
    """
    label = "avg_{}" if plain_names else "avg({})"
    return df.groupBy(by).agg(*[_mean(df, v).alias(label.format(v)) for v in STATS_VALUES])


def stats_states(df: DataFrame, by: str = "subreddit") -> DataFrame:
    """What the means of ``group_stats`` are made of: a sum and a count per group and value.

    States of parts of a table, such as the runs of a job, add up, so the
    statistics of all runs need no look at earlier posts.
    """
    parts = []
    for value in STATS_VALUES:
        known = number(df, value) if value in df.columns else F.lit(None)
        parts.append(F.sum(known.cast("double")).alias(f"{value}_sum"))
        parts.append(F.count(known).alias(f"{value}_n"))
    return df.groupBy(by).agg(*parts)


def stats_of_states(states: DataFrame, by: str = "subreddit") -> DataFrame:
    """``group_stats`` of everything that the states were taken of."""
    means = [
        F.try_divide(F.sum(f"{value}_sum"), F.sum(f"{value}_n")).alias(f"avg_{value}") for value in STATS_VALUES
    ]
    return states.groupBy(by).agg(*means)


def mean_ranking(stats: DataFrame, value: str = "avg_sentiment", by: str = "subreddit") -> DataFrame:
    """Groups of a stats table by descending mean."""
    return stats.select(by, value).orderBy(F.desc_nulls_last(value), F.asc(by))


def global_kpis(posts: DataFrame, comments: DataFrame | None = None) -> DataFrame:
    """One row: number of posts and comments, mean score, mean sentiment.

    A missing comment table counts as no comments, a missing column as NULL.
    """
    n_comments = (
        F.lit(0).cast("bigint")
        if comments is None
        else comments.agg(_rows().alias("n")).scalar()
    )
    return posts.agg(
        _rows().alias("n_posts"),
        _mean(posts, "score").alias("avg_score"),
        _mean(posts, "sentiment").alias("avg_sentiment"),
    ).withColumn("n_comments", n_comments)


def group_kpis(df: DataFrame, by: str = "subreddit") -> DataFrame:
    """Posts, highest score, mean sentiment and share of positive posts, for all groups at once."""
    positive = F.when(is_positive(number(df, "sentiment")), 1.0).otherwise(0.0)
    return (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            _rows().alias("n_posts"),
            F.max(number(df, "score")).alias("max_score"),
            _mean(df, "sentiment").alias("avg_sentiment"),
            (F.avg(positive) * 100).alias("positive_pct"),
        )
    )


def sentiment_split(df: DataFrame, by: str | None = None, value: str = "sentiment") -> DataFrame:
    """Positive, negative and neutral rows with their shares of the three together."""
    sentiment = number(df, value)
    grouped = df.groupBy() if by is None else df.filter(F.col(by).isNotNull()).groupBy(by)
    counts = grouped.agg(
        F.count_if(is_positive(sentiment)).alias("positive"),
        F.count_if(is_negative(sentiment)).alias("negative"),
        F.count_if(is_neutral(sentiment)).alias("neutral"),
    )
    total = F.col("positive") + F.col("negative") + F.col("neutral")
    shares = {
        f"{side}_pct": F.try_divide(F.col(side) * 100.0, total)
        for side in ("positive", "negative", "neutral")
    }
    return counts.withColumns(shares)


def volume(df: DataFrame, by: str = "subreddit") -> DataFrame:
    """Rows per group, most first."""
    return (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(_rows().alias("n"))
        .orderBy(F.desc("n"), F.asc(by))
    )


def distinct_groups(df: DataFrame, by: str = "subreddit") -> DataFrame:
    return df.select(by).filter(F.col(by).isNotNull()).distinct().orderBy(by)


def author_activity(
    df: DataFrame,
    author: str = "author",
    by: str | None = None,
    na_tokens: tuple[str, ...] = ("None",),
) -> DataFrame:
    """Posts per author. Missing authors are left out, and so are the ``na_tokens``."""
    keys = [author] if by is None else [by, author]
    kept = df
    for key in keys:
        kept = kept.filter(F.col(key).isNotNull())
    if na_tokens:
        kept = kept.filter(~F.col(author).cast("string").isin(*na_tokens))
    return kept.groupBy(*keys).agg(_rows().alias("posts"))
