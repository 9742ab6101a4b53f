"""Keyword frequencies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions import STOPWORDS, not_stopword, post_text, tokens
from murmura.operators.ranking import top_k_per_group


def keyword_counts(
    df: DataFrame,
    text_cols: Sequence[str] = ("title", "body"),
    by: str | None = None,
    stopwords: Iterable[str] | DataFrame = STOPWORDS,
    min_length: int = 4,
) -> DataFrame:
    """How often each word occurs, as ``(by, word, freq)``.

    The words of a text are counted within its task first; only distinct
    words travel. ``stopwords`` may be a one-column frame of any size; it is
    applied to the counted words, not to every occurrence.
    """
    keys = [] if by is None else [by]
    if by is not None:
        df = df.filter(F.col(by).isNotNull())
    text = post_text(*[F.col(c) for c in text_cols])
    words = df.select(*keys, F.explode(tokens(text, min_length)).alias("word"))
    listed = isinstance(stopwords, DataFrame)
    if not listed:
        words = words.filter(not_stopword(F.col("word"), stopwords))
    counts = words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("freq"))
    if listed:
        unwanted = stopwords.select(F.col(stopwords.columns[0]).alias("word"))
        counts = counts.join(unwanted, "word", "left_anti")
        counts = counts.select(*keys, "word", "freq")
    return counts


def top_keywords(
    df: DataFrame,
    k: int = 20,
    text_cols: Sequence[str] = ("title", "body"),
    by: str | None = None,
    stopwords: Iterable[str] | DataFrame = STOPWORDS,
    min_length: int = 4,
) -> DataFrame:
    """The ``k`` most frequent words, over the whole table or per group."""
    counts = keyword_counts(df, text_cols, by, stopwords, min_length)
    order = [F.desc("freq"), F.asc("word")]
    if by is None:
        return counts.orderBy(*order).limit(k)
    # Counted words are already spread by word; few candidates are left per task.
    return top_k_per_group(counts, [by], order, k, parts=0)
