"""Joins that hold up when sizes are very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

MAX_SMALL = 100_000


def small(df: DataFrame, max_rows: int = MAX_SMALL) -> DataFrame:
    """Mark a summary for broadcast, with a check of its size when the query runs.

    For tables whose size is bounded by an argument. With more than
    ``max_rows`` rows the query fails and says so, rather than to broadcast
    without bound or to lose rows.
    """
    total = F.count(F.lit(1)).over(W.partitionBy())
    message = F.lit(f"more than {max_rows} rows in a table meant for broadcast")
    checked = df.limit(max_rows + 1).withColumn("_rows_in_small", total)
    fits = F.when(F.col("_rows_in_small") > max_rows, F.raise_error(message).cast("boolean")).otherwise(True)
    return F.broadcast(checked.filter(fits).drop("_rows_in_small"))


def with_group_row(rows: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` with the one row of their group, for any number of groups.

    Spark broadcasts a summary below its own threshold. Beyond, a second,
    dependent join key brings the summary an exchange of its own (see
    ``per_key``), so that adaptive execution splits a hot group.
    """
    dependent = F.hash(*by)
    keyed = summary.withColumn("_dependent", dependent)
    return rows.withColumn("_dependent", dependent).join(keyed, [*by, "_dependent"]).drop("_dependent")


def per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The least ``value`` of each ``key``, for a join in which a hot key of the other side is split.

    Adaptive execution splits a skewed join only if both sides come straight
    from the join's own exchange. Grouping by a second, dependent key keeps
    Spark from serving the join with the exchange of the aggregate.
    """
    dependent = F.hash(key).alias("_dependent")
    return df.groupBy(key, dependent).agg(F.min(value).alias(value)).drop("_dependent")
