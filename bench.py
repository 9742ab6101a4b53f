"""Time the queries: one warm-up, then the median of the runs. Prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
timed runs and ``BENCH_QUERIES`` a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from acceptance.queries import QUERIES
from murmura.session import local_session

HEADLINE = [
    "group_stats",
    "clean_posts",
    "global_kpis",
    "group_kpis",
    "sentiment_split_per_group",
    "hourly_volume",
    "hourly_mean",
    "hour_of_day",
    "daily_volume",
    "daily_matrix",
    "box_minmax",
    "box_tukey",
    "histogram20",
    "binned_scatter",
    "keywords_top20",
    "keywords_per_group",
    "lexicon_scores",
    "top_posts",
    "top_posts_per_group",
    "top_authors",
    "latest_posts",
    "first_comments",
    "comment_kpis",
    "top_comments",
    "comment_volume",
    "prompt_context",
    "transcripts",
    "posts_csv_roundtrip",
    "batch_job",
]


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
