"""Volumes and means over time. Buckets are in UTC; empty buckets are not listed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions import hour_bucket, number, utc
from murmura.operators.order import numbered


def _hourly(df: DataFrame, ts: str, by: Sequence[str]) -> DataFrame:
    for key in by:
        df = df.filter(F.col(key).isNotNull())
    return df.withColumn("hour_start", hour_bucket(utc(df, ts)))


def hourly_volume(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per hour, and per group if ``by`` names group columns."""
    return _hourly(df, ts, by).groupBy("hour_start", *by).agg(F.count(F.lit(1)).alias("n"))


def hourly_mean(df: DataFrame, ts: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of ``value`` per hour."""
    mean = F.avg(number(df, value)).alias(f"avg_{value}")
    return _hourly(df, ts, by).groupBy("hour_start", *by).agg(mean)


def hour_of_day_profile(
    df: DataFrame, ts: str, value: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows and mean of ``value`` for each hour of the day (0-23)."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    if value is not None:
        aggregates.append(F.avg(number(df, value)).alias(f"avg_{value}"))
    dated = df.withColumn("hour_of_day", F.hour(utc(df, ts)))
    for key in ("hour_of_day", *by):
        dated = dated.filter(F.col(key).isNotNull())
    return dated.groupBy(*by, "hour_of_day").agg(*aggregates)


def daily_volume(df: DataFrame, ts: str, by: str = "subreddit") -> DataFrame:
    """Rows per day and group in long form, for any number of groups."""
    dated = df.withColumn("day", F.to_date(utc(df, ts)))
    return (
        dated.filter(F.col("day").isNotNull() & F.col(by).isNotNull())
        .groupBy("day", by)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def daily_volume_matrix(
    df: DataFrame, ts: str, by: str = "subreddit", groups: Sequence[str] | None = None
) -> DataFrame:
    """One row per day and one column per group; 0 where a group has no rows that day.

    Naming the ``groups`` saves the job that finds them; the rows of all
    others are counted in the column ``other``. Without names Spark refuses
    more than ``spark.sql.pivotMaxValues`` groups; ``daily_volume`` and
    ``daily_volume_pages`` have no such bound.
    """
    daily = daily_volume(df, ts, by)
    if groups is not None:
        if "other" in groups:
            raise ValueError("'other' is the column of the groups that are not named")
        named = F.when(F.col(by).isin(list(groups)), F.col(by)).otherwise("other")
        daily, groups = daily.withColumn(by, named), [*groups, "other"]
    # Pivot the small per-day counts, so that the source is aggregated once.
    return daily.groupBy("day").pivot(by, groups).agg(F.sum("n")).na.fill(0)


def daily_volume_pages(
    df: DataFrame, ts: str, by: str = "subreddit", groups_per_page: int = 100
) -> DataFrame:
    """The matrix for any number of groups: ``(page, day, groups, n)``, no pivot and no job before it runs.

    Pages hold ``groups_per_page`` groups in the order of their names, the
    same in every row of a page; ``n`` are their rows of the day, 0 where a
    group has none. A day is on the pages whose groups have rows that day.
    """
    daily = daily_volume(df, ts, by)
    places = numbered(daily, by).select(
        by,
        F.floor(F.col("place") / groups_per_page).alias("page"),
        (F.col("place") % groups_per_page).cast("int").alias("slot"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("slot", by)))
    pages = places.groupBy("page").agg(F.transform(ordered, lambda x: x[by]).alias("groups"))
    cells = daily.join(places, by).groupBy("page", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("cells")
    )
    slots = F.sequence(F.lit(0), F.size("groups") - 1)
    n = F.transform(slots, lambda slot: F.coalesce(F.col("cells")[slot], F.lit(0)))
    return cells.join(pages, "page").select("page", "day", "groups", n.alias("n"))
