"""Comments of a set of posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions import in_order_desc, number
from murmura.operators.kpis import volume
from murmura.operators.late import BUNDLES, maybe_among, same_keys
from murmura.operators.ranking import top_k_per_group
from murmura.operators.skew import per_key, small


def _owners(posts: DataFrame, by: str, post_id: str) -> DataFrame:
    """Distinct pairs of post and group; the join that follows brings its own exchange."""
    kept = posts.filter(F.col(by).isNotNull() & F.col("id").isNotNull())
    return kept.select(F.col("id").alias(post_id), by).distinct()


def cohort_comments(posts: DataFrame, comments: DataFrame, post_id: str = "post_id") -> DataFrame:
    """Comments whose post is among ``posts``; a post loaded twice does not double them."""
    ids = posts.select(F.col("id").alias(post_id))
    return comments.join(ids, post_id, "left_semi").select(*comments.columns)


def with_group(
    comments: DataFrame, posts: DataFrame, by: str = "subreddit", post_id: str = "post_id"
) -> DataFrame:
    """Comments with the group of their post, unless they carry a group themselves."""
    if by in comments.columns:
        return comments
    groups = per_key(posts.select(F.col("id").alias(post_id), by), post_id, by)
    return comments.join(groups, post_id, "left").select(*comments.columns, by)


def comment_volume(
    comments: DataFrame,
    posts: DataFrame | None = None,
    by: str = "subreddit",
    post_id: str = "post_id",
) -> DataFrame:
    """Comments per group, most first; the group comes from the post where comments lack it."""
    if by in comments.columns:
        return volume(comments, by)
    if posts is None:
        raise ValueError(f"comments have no column {by!r}, so posts are needed")
    per_post = comments.groupBy(post_id).agg(F.count(F.lit(1)).alias("n"))
    groups = posts.groupBy(F.col("id").alias(post_id)).agg(F.min(by).alias(by))
    return (
        per_post.join(groups.filter(F.col(by).isNotNull()), post_id)
        .groupBy(by)
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), F.asc(by))
    )


def comment_kpis(
    posts: DataFrame, comments: DataFrame, by: str = "subreddit", post_id: str = "post_id"
) -> DataFrame:
    """Number and mean sentiment of the comments on each group's posts.

    Comments are summed up per post before they meet the posts, so a post
    with very many comments is one row in the join.
    """
    sentiment = number(comments, "sentiment")
    per_post = comments.groupBy(post_id).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(sentiment).alias("total"),
        F.count(sentiment).alias("scored"),
    )
    return (
        per_post.join(_owners(posts, by, post_id), post_id)
        .groupBy(by)
        .agg(
            F.sum("n").alias("n_comments"),
            F.try_divide(F.sum("total"), F.sum("scored")).alias("avg_comment_sentiment"),
        )
    )


def _listed(comments: DataFrame) -> list[str]:
    wanted = ["id", "body", "author", "score", "sentiment"]
    return [c for c in wanted if c in comments.columns]


def _slim(comments: DataFrame, post_id: str) -> DataFrame:
    """What a ranking needs: ``row`` tells comments apart that have the same id or none."""
    content = F.xxhash64(*[c for c in _listed(comments) if c != "sentiment"])
    return comments.select("id", post_id, "score", content.alias("row"))


def _fetched(comments: DataFrame, keys: DataFrame, post_id: str, most: int) -> DataFrame:
    """The comments of at most ``most`` ranked keys, with all columns and those that the keys add.

    A comment without id is found as well. What else has the same hash only
    adds candidates, and the caller ranks once more.
    """
    content = F.xxhash64(*[c for c in _listed(comments) if c != "sentiment"])
    added = [c for c in keys.columns if c not in ("id", post_id, "row", "score", "rank")]
    distinct = keys.select(F.col(post_id).alias("_post"), F.col("row").alias("_row"), *added).distinct()
    same = F.col(post_id).eqNullSafe(F.col("_post")) & (F.col("_content") == F.col("_row"))
    found = comments.withColumn("_content", content).join(small(distinct, most), same)
    return found.drop("_content", "_post", "_row")


def top_comments(
    posts: DataFrame, comments: DataFrame, k: int = 10, post_id: str = "post_id"
) -> DataFrame:
    """The ``k`` best-scored comments on ``posts``.

    Ranks the keys alone, then fetches the texts of the winners: at most
    ``k`` keys are broadcast and no text is shuffled.
    """
    order = [in_order_desc(comments, "score"), F.asc("id")]
    winners = cohort_comments(posts, _slim(comments, post_id), post_id).orderBy(*order, "row").limit(k)
    found = _fetched(comments, winners, post_id, k)
    listed = _listed(comments)
    return found.orderBy(*order, *listed).limit(k).select(*listed)


def top_comments_per_group(
    posts: DataFrame,
    comments: DataFrame,
    k: int = 10,
    by: str = "subreddit",
    post_id: str = "post_id",
    late: bool = False,
) -> DataFrame:
    """The ``k`` best-scored comments on the posts of every group.

    The best ``k`` of each post are found first, so a post with very many
    comments meets its groups with ``k`` rows. Each task cuts its posts to
    ``k`` before their texts are shuffled, so any number of groups will do.

    That cuts little where most posts have fewer than ``k`` comments. ``late``
    therefore ranks keys without texts, drops the comments that cannot be
    among the winners where they are read, and shuffles the texts of the rest
    alone; it reads the comments three times, of which once with their texts.
    """
    listed = _listed(comments)
    if not late:
        order = [in_order_desc(comments, "score"), F.asc("id"), *map(F.asc, listed)]
        slim = comments.select(*dict.fromkeys([post_id, *listed, "id", "score"]))
        best = top_k_per_group(slim, [post_id], order, k).drop("rank")
        owned = best.join(_owners(posts, by, post_id), post_id)
        return top_k_per_group(owned, [by], order, k, parts=0).select(by, "rank", *listed)
    scored = comments.select(*dict.fromkeys([post_id, "id", *listed]), number(comments, "score").alias("_score"))
    keys = [post_id, "id", "_score"]
    order = [F.desc_nulls_last("_score"), F.asc("id")]
    part = F.hash(*keys)
    best = top_k_per_group(scored.select(*keys), [post_id], order, k, parts=BUNDLES, part=part).drop("rank")
    owned = best.join(_owners(posts, by, post_id), post_id)
    winners = top_k_per_group(owned, [by], order, k, parts=0).select(by, *keys).distinct()
    near = scored.drop(by) if by in scored.columns else scored
    found = same_keys(maybe_among(near, winners, [post_id, "id"]), winners, keys)
    return top_k_per_group(found, [by], [*order, *map(F.asc, listed)], k).select(by, "rank", *listed)
