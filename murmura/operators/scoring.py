"""From raw records to processed ones: cleaning, typing and sentiment.

The column-wise functions work on streams as well as on tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.functions import (
    clean_text,
    keyword_sentiment,
    nan_to_null,
    post_text,
    to_double,
    to_int,
    tokens,
)

Scorer = Callable[[Column], Column]


def with_clean_text(
    df: DataFrame, text_cols: Sequence[str] = ("body",), name: str = "clean_body"
) -> DataFrame:
    return df.withColumn(name, clean_text(post_text(*[F.col(c) for c in text_cols])))


def with_sentiment(
    df: DataFrame, scorer: Scorer = keyword_sentiment, text: str = "clean_body"
) -> DataFrame:
    """Add ``sentiment``. The scorer may be any column function or a pandas UDF."""
    return df.withColumn("sentiment", nan_to_null(scorer(F.col(text)).cast("double")))


def process_posts(
    raw: DataFrame,
    scorer: Scorer = keyword_sentiment,
    text_cols: Sequence[str] = ("body",),
    int_mode: str = "strict",
) -> DataFrame:
    """Raw posts with ``clean_body``, ``sentiment`` and typed numbers."""
    scored = with_sentiment(with_clean_text(raw, text_cols), scorer)
    return scored.withColumns(
        {
            "score": to_double(F.col("score")),
            "num_comments": to_int(F.col("num_comments"), int_mode),
        }
    )


def process_comments(raw: DataFrame, scorer: Scorer = keyword_sentiment) -> DataFrame:
    """Raw comments with ``clean_body``, ``sentiment`` and a typed score."""
    scored = with_sentiment(with_clean_text(raw), scorer)
    return scored.withColumn("score", to_double(F.col("score")))


def lexicon_scorer(lexicon: Mapping[str, float]) -> Scorer:
    """A scorer: the mean polarity of a text's lexicon words, within [-1, 1].

    A text without lexicon words scores 0. Words are found by Spark and looked
    up in the row's own task by a pandas UDF, which carries the lexicon: a
    word list of a language, not a table that grows with the data. Nothing is
    joined or shuffled, so no word and no id can be a hot key, and every row
    is scored by itself.
    """
    polarity = {word: float(value) for word, value in lexicon.items() if value is not None}

    @F.pandas_udf("double")
    def mean(words: pd.Series) -> pd.Series:
        found = words.map(lambda ws: [polarity[w] for w in ws if w in polarity])
        return found.map(lambda values: max(-1.0, min(1.0, sum(values) / len(values))) if values else 0.0)

    return lambda text: mean(tokens(F.coalesce(text, F.lit(""))))


def lexicon_sentiment(
    df: DataFrame, lexicon: Mapping[str, float], text: str = "clean_body"
) -> DataFrame:
    """``df`` with ``sentiment``, each row scored by ``lexicon_scorer``."""
    return with_sentiment(df, lexicon_scorer(lexicon), text)


def polarity_sentiment(df: DataFrame, lexicon: DataFrame, text: str = "clean_body") -> DataFrame:
    """``df`` with ``sentiment`` from a lexicon of any size, a table of word and polarity.

    The same scores as ``lexicon_sentiment``, by joins instead of a Python
    look-up. A score depends on the text alone, so it is worked out per text:
    each text's words are counted in their row, joined with the lexicon, which
    Spark broadcasts below its own threshold, and summed by a hash of the text.
    A text's words come one after another, so its sums are complete before
    they are shuffled: a hash and two numbers each. The scores are joined back
    by that hash; columns of ``df`` that nobody asks for do not travel.

    Words are not a hot key: beyond the threshold adaptive execution splits a
    frequent one, as it does a text with many copies. Rows of the lexicon
    without word or polarity count for nothing, equal words are averaged, and
    a text without lexicon words, an empty or a missing one scores 0.
    """
    listed = lexicon.filter("word IS NOT NULL AND polarity IS NOT NULL AND NOT isnan(polarity)")
    # Dependent keys give the joins exchanges of their own, so that hot keys can be split (see ``skew.per_key``).
    listed = listed.groupBy("word", F.hash("word").alias("_dependent")).agg(
        F.avg(F.col("polarity").cast("double")).alias("_polarity")
    )
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.sha2(body, 256)
    found = df.select(key.alias("_text"), F.explode(tokens(body)).alias("word"))
    hits = found.join(listed.drop("_dependent"), "word")
    scores = hits.groupBy("_text", F.hash("_text").alias("_dependent")).agg(
        F.avg("_polarity").alias("_mean")
    )
    rows = df.drop("sentiment").withColumn("_text", key)
    scored = rows.join(scores.drop("_dependent"), "_text", "left")
    mean = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce("_mean", F.lit(0.0))))
    return scored.withColumn("sentiment", mean).drop("_text", "_mean")


def read_lexicon(spark: SparkSession, path: str, max_words: int = 1_000_000) -> dict[str, float]:
    """A lexicon from a CSV file with the columns word and polarity.

    Equal words are averaged. A file of more than ``max_words`` words is an error.
    """
    rows = spark.read.schema("word string, polarity double").option("header", True).csv(path)
    means = rows.filter("word IS NOT NULL AND polarity IS NOT NULL").groupBy("word")
    found = means.agg(F.avg("polarity").alias("polarity")).limit(max_words + 1).collect()
    if len(found) > max_words:
        raise ValueError(f"{path} has more than {max_words} words")
    return {row["word"]: row["polarity"] for row in found}
