"""Sentiment scores and the sign predicates the KPIs are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def keyword_sentiment(
    text: Column, positive: Sequence[str] = ("good",), negative: Sequence[str] = ("bad",)
) -> Column:
    """0.5 if a positive word occurs as a substring, else -0.5 for a negative one, else 0."""
    return (
        F.when(_contains_any(text, positive), 0.5)
        .when(_contains_any(text, negative), -0.5)
        .otherwise(0.0)
    )


def is_positive(sentiment: Column) -> Column:
    return F.coalesce(sentiment > 0, F.lit(False))


def is_negative(sentiment: Column) -> Column:
    return F.coalesce(sentiment < 0, F.lit(False))


def is_neutral(sentiment: Column) -> Column:
    return F.coalesce(sentiment == 0, F.lit(False))
