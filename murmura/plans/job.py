"""The batch job: landed CSV to processed tables and per-group statistics."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from murmura.functions import keyword_sentiment
from murmura.operators.kpis import stats_of_states, stats_states
from murmura.operators.scoring import (
    Scorer,
    lexicon_scorer,
    process_comments,
    process_posts,
    read_lexicon,
)
from murmura.schemas import STATS_STATES
from murmura.session import tune
from murmura.sources.landing import read_comments, read_posts
from murmura.sources.tables import CatalogStore, FolderStore, JdbcStore

log = logging.getLogger(__name__)

Store = FolderStore | CatalogStore | JdbcStore


@dataclass(frozen=True)
class JobResult:
    posts: int
    comments: int


def run_job(
    spark: SparkSession,
    landing: str,
    store: Store,
    scorer: Scorer = keyword_sentiment,
    int_mode: str = "strict",
    run: str | None = None,
    sort_by: str | None = "subreddit",
) -> JobResult:
    """Process the landing folder's ``posts.csv`` and ``comments.csv`` into ``store``.

    Posts and comments are appended, statistics of this run's posts replace
    the earlier ones. What the statistics are made of is appended as well, so
    that ``cumulative_stats`` has those of all runs. Statistics and row counts
    read the columns just written, so that texts are parsed and scored once. Posts and comments are
    independent: no posts does not mean no comments. Errors surface to the
    caller.

    Each task sorts its rows by ``sort_by`` before it writes them. That costs
    no shuffle, and lets a filter on the group skip most of every file.
    """

    def sorted_rows(df: DataFrame) -> DataFrame:
        return df if sort_by is None else df.sortWithinPartitions(sort_by)

    n_posts = n_comments = 0
    posts = read_posts(spark, f"{landing}/posts.csv")
    if posts.isEmpty():
        log.warning("no posts in %s", landing)
    else:
        rows = sorted_rows(process_posts(posts, scorer, int_mode=int_mode))
        written = store.append(rows, "posts", run)
        states = store.append(stats_states(written), "stats_states", run)
        store.replace(stats_of_states(states), "stats")
        n_posts = written.count()
    comments = read_comments(spark, f"{landing}/comments.csv")
    if comments.isEmpty():
        log.warning("no comments in %s", landing)
    else:
        rows = sorted_rows(process_comments(comments, scorer))
        n_comments = store.append(rows, "comments", run).count()
    return JobResult(n_posts, n_comments)


def cumulative_stats(store: Store) -> DataFrame:
    """Mean score, sentiment and comment count per group over all runs.

    Adds up a few numbers per run and group; no post is read again. A repeated
    run has replaced its own numbers, and as runs are only ever added, a
    reader never finds the statistics missing.
    """
    return stats_of_states(store.read("stats_states", STATS_STATES))


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=run_job.__doc__.splitlines()[0])
    parser.add_argument("landing", help="folder with posts.csv and comments.csv")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--folder", help="write Parquet tables below this folder")
    target.add_argument("--catalog", action="store_true", help="write tables of the catalog")
    target.add_argument("--jdbc-url", help="write tables of this database")
    parser.add_argument("--prefix", default="", help="prefix of the table names")
    parser.add_argument(
        "--property", action="append", default=[], metavar="KEY=VALUE", help="JDBC property"
    )
    parser.add_argument("--int-mode", choices=("strict", "lenient"), default="strict")
    parser.add_argument("--lexicon", help="CSV of word and polarity to score with, instead of good and bad")
    parser.add_argument(
        "--run", help="name of this run; repeating a run replaces its rows (not for a database)"
    )
    args = parser.parse_args(argv)

    spark = tune(SparkSession.builder.appName("murmura-job").getOrCreate())
    if args.folder:
        store: Store = FolderStore(spark, args.folder)
    elif args.catalog:
        store = CatalogStore(spark, args.prefix)
    else:
        properties = dict(p.split("=", 1) for p in args.property)
        store = JdbcStore(spark, args.jdbc_url, properties, args.prefix)
    scorer = lexicon_scorer(read_lexicon(spark, args.lexicon)) if args.lexicon else keyword_sentiment
    result = run_job(spark, args.landing, store, scorer, args.int_mode, args.run)
    log.info("%d posts, %d comments", result.posts, result.comments)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
