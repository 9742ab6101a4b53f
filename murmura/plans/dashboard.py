"""The dashboard's and the report's views as named frames. All of them are lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions import number, report_title
from murmura.operators.cohorts import cohort_comments, comment_volume, top_comments
from murmura.operators.distributions import box_stats, histogram, scatter_rows
from murmura.operators.keywords import top_keywords
from murmura.operators.kpis import (
    global_kpis,
    group_kpis,
    group_stats,
    mean_ranking,
    sentiment_split,
)
from murmura.operators.ranking import top_authors, top_posts, top_posts_per_group
from murmura.operators.trends import (
    daily_volume,
    hour_of_day_profile,
    hourly_mean,
    hourly_volume,
)
from murmura.sources.landing import in_groups
from murmura.sources.tables import resolve_column

Views = dict[str, DataFrame]


def market_view(
    posts: DataFrame,
    comments: DataFrame | None = None,
    stats: DataFrame | None = None,
    by: str = "subreddit",
    ts: str = "created_utc",
) -> Views:
    """All groups side by side."""
    stats = group_stats(posts, by) if stats is None else stats
    views = {
        "kpis": global_kpis(posts, comments),
        "volume_by_hour": hourly_volume(posts, ts, [by]),
        "mean_sentiment": mean_ranking(stats, resolve_column(stats, "avg_sentiment"), by),
        "sentiment_boxes": box_stats(posts, "sentiment", [by]),
        "sentiment_vs_score": scatter_rows(posts, by),
    }
    if comments is not None:
        views["comment_volume"] = comment_volume(comments, posts, by)
    return views


def group_view(
    posts: DataFrame,
    group: str,
    comments: DataFrame | None = None,
    by: str = "subreddit",
    ts: str = "created_utc",
) -> Views:
    """One group in detail. The group's filter reaches the scan of every view."""
    own = posts.filter(in_groups([group], by))
    views = {
        "kpis": group_kpis(own, by),
        "volume_by_hour": hourly_volume(own, ts),
        "sentiment_by_hour": hourly_mean(own, ts, "sentiment"),
        "keywords": top_keywords(own, 20),
        "sentiment_split": sentiment_split(own),
        "top_authors": top_authors(own, 10),
        "top_posts": top_posts(own, 5),
    }
    if comments is not None:
        cohort = cohort_comments(own, comments)
        views["comment_kpis"] = cohort.agg(
            F.count(F.lit(1)).alias("n_comments"),
            F.avg(number(cohort, "sentiment")).alias("avg_comment_sentiment"),
        )
        views["top_comments"] = top_comments(own, comments, 10)
    return views


def report(posts: DataFrame, by: str = "subreddit", ts: str = "created_utc") -> Views:
    """The report's tables. What it shows group after group is one pass over all groups here."""
    best = top_posts_per_group(posts, 5, by)
    return {
        "kpis": global_kpis(posts),
        "mean_sentiment": group_stats(posts, by).select(by, "avg_sentiment"),
        "volume_by_day": daily_volume(posts, ts, by),
        "sentiment_boxes": box_stats(posts, "sentiment", [by], whisker="tukey"),
        "sentiment_vs_score": scatter_rows(posts, by),
        "sentiment_histogram": histogram(posts, "sentiment", 20),
        "group_kpis": group_kpis(posts, by),
        "hour_of_day": hour_of_day_profile(posts, ts, "sentiment", [by]),
        "sentiment_split": sentiment_split(posts, by),
        "keywords": top_keywords(posts, 15, by=by),
        "top_posts": best.select(
            by, "rank", report_title(F.col("title")).alias("title"), "score", "sentiment"
        ),
    }
