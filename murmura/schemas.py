"""Schemas of the landed records and of the processed tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _with_types(raw: T.StructType, types: dict[str, T.DataType]) -> T.StructType:
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in raw]
    return T.StructType(
        fields
        + [T.StructField("clean_body", T.StringType()), T.StructField("sentiment", T.DoubleType())]
    )


# Landed CSV: every column is text.
POSTS_RAW = _strings(
    "id", "title", "body", "score", "author", "created_utc", "subreddit", "url", "num_comments"
)
COMMENTS_RAW = _strings("id", "post_id", "body", "author", "score", "created_utc", "subreddit")

# Processed tables.
POSTS = _with_types(POSTS_RAW, {"score": T.DoubleType(), "num_comments": T.IntegerType()})
COMMENTS = _with_types(COMMENTS_RAW, {"score": T.DoubleType()})
STATS = T.StructType(
    [
        T.StructField("subreddit", T.StringType()),
        T.StructField("avg_score", T.DoubleType()),
        T.StructField("avg_sentiment", T.DoubleType()),
        T.StructField("avg_num_comments", T.DoubleType()),
    ]
)
# Per run: what the means of STATS are made of.
STATS_STATES = T.StructType(
    [T.StructField("subreddit", T.StringType())]
    + [
        field
        for value in ("score", "sentiment", "num_comments")
        for field in (T.StructField(f"{value}_sum", T.DoubleType()), T.StructField(f"{value}_n", T.LongType()))
    ]
)
