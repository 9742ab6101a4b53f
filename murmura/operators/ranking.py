"""Rankings and per-group limits, always with a total order so that ties are stable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window as W

from murmura.functions import in_order_desc, utc
from murmura.operators.kpis import author_activity

_PART = "_part"


def top_k_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    parts: int = 32,
    part: Column | None = None,
) -> DataFrame:
    """The first ``k`` rows of every group by ``order``, numbered from 1 in ``rank``.

    Spark limits each group within a task before it shuffles. What remains of
    a hot group is still ``k`` rows for every task, so the tasks are first
    merged in ``parts`` bundles and only the winners of the bundles meet in
    one task. Where that has little to cut, with many small groups or after an
    aggregation, ``parts=0`` saves the extra shuffle. A bundle takes whole
    tasks, or rows by the number ``part`` where the plan must not depend on
    the tasks.
    """
    by = list(by)
    for key in by:
        df = df.filter(F.col(key).isNotNull())
    if parts:
        bundle = W.partitionBy(*by, _PART).orderBy(*order)
        df = (
            df.withColumn(_PART, (F.spark_partition_id() if part is None else part) % parts)
            .withColumn(rank, F.row_number().over(bundle))
            .filter(F.col(rank) <= k)
            .drop(_PART, rank)
        )
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(
        F.col(rank) <= k
    )


def latest_n_per_group(
    df: DataFrame, n: int, by: str = "subreddit", ts: str = "created_utc", key: str = "id"
) -> DataFrame:
    """The newest ``n`` posts of every group. ``ts`` may be epoch seconds as text."""
    return top_k_per_group(df, [by], [F.desc_nulls_last(utc(df, ts)), F.asc(key)], n)


def first_k_per_parent(
    comments: DataFrame, k: int = 5, parent: str = "post_id", ordinal: str = "ordinal"
) -> DataFrame:
    """The first ``k`` comments of every post in their given order; 0 gives none."""
    ties = [F.asc("id")] if "id" in comments.columns else []
    return top_k_per_group(comments, [parent], [F.asc(ordinal), *ties], k, parts=0)


def group_sample(
    df: DataFrame, n: int = 15, by: str = "subreddit", ts: str = "created_utc", key: str = "id"
) -> DataFrame:
    """The ``n`` newest posts of every group, as context for a prompt."""
    return latest_n_per_group(df, n, by, ts, key)


def _post_columns(posts: DataFrame, *first: str) -> list[str]:
    wanted = [*first, "title", "score", "sentiment", "num_comments"]
    return [c for c in wanted if c in posts.columns]


def top_posts(posts: DataFrame, k: int = 5, key: str = "id") -> DataFrame:
    """The best-scored posts; the comment count is listed if the table has it."""
    ordered = posts.orderBy(in_order_desc(posts, "score"), F.asc(key)).limit(k)
    return ordered.select(*_post_columns(posts, key))


def top_posts_per_group(
    posts: DataFrame, k: int = 5, by: str = "subreddit", key: str = "id"
) -> DataFrame:
    """The best-scored posts of every group in one pass."""
    slim = posts.select(*_post_columns(posts, by, key))
    return top_k_per_group(slim, [by], [in_order_desc(slim, "score"), F.asc(key)], k)


def top_authors(
    posts: DataFrame, k: int = 10, by: str | None = None, author: str = "author"
) -> DataFrame:
    """The most active authors, over all posts or per group."""
    activity = author_activity(posts, author, by)
    order = [F.desc("posts"), F.asc(author)]
    if by is None:
        return activity.orderBy(*order).limit(k)
    return top_k_per_group(activity, [by], order, k, parts=0)


def dedupe_by_id(df: DataFrame, key: str = "id", latest: Sequence[Column] = ()) -> DataFrame:
    """One row per id: the first by ``latest``, e.g. the newest load.

    Within each task all but one copy go before the shuffle, so copies of one
    id never meet in great numbers. Rows without an id are kept as they are.
    """
    # Copies that are equally late are told apart by a hash of their content.
    content = [f.name for f in df.schema if not isinstance(f.dataType, MapType)]
    order = [*latest, F.xxhash64(*content)]
    unique = top_k_per_group(df, [key], order, 1, rank="_copy", parts=0).drop("_copy")
    return unique.unionByName(df.filter(F.col(key).isNull()))
