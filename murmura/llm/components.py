"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.sources.scratch import stage


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of the links (a, b).

    Each round a node takes the least root among its own and its neighbours',
    and then the root of that root, until nothing changes. Minima are combined
    in each task before the shuffle, so a node with very many links is no hot
    key. Every round is written to the shared folder.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a IS NOT NULL AND b IS NOT NULL")
    edges = stage(both.toDF("node", "other").distinct(), "edges")
    start = edges.groupBy("node").agg(F.least(F.min("node"), F.min("other")).alias("root"))
    labels = stage(start, "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), "root"), "other")
        least = near.groupBy("node").agg(F.min("root").alias("near"))
        moved = labels.join(least, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("via")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        moved = stage(
            moved.join(jump, "via", "left").select(
                "node", "old", F.least("via", F.coalesce("far", "via")).alias("root")
            ),
            "labels",
        )
        labels = moved.select("node", "root")
        if moved.filter("old != root").limit(1).count() == 0:
            return labels
