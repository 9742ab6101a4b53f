from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from murmura.operators import kpis, ranking, trends
from murmura.sources.tables import resolve_column

NAN = float("nan")
POSTS = [
    (1, "a", 10.0, 0.5, 1, "ann"),
    (2, "a", NAN, -0.5, None, "bob"),
    (3, "a", 4.0, 0.0, 3, "ann"),
    (4, "a", None, NAN, 5, "None"),
    (5, "b", 7.0, None, 2, None),
    (6, None, 1.0, 0.5, 4, "cat"),
]
SCHEMA = "id int, subreddit string, score double, sentiment double, num_comments int, author string"


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_group_stats_keep_the_null_group(posts, rows):
    assert rows(kpis.group_stats(posts)) == sorted(
        [("a", 7.0, 0.0, 3.0), ("b", 7.0, None, 2.0), (None, 1.0, 0.5, 4.0)], key=repr
    )


def test_group_stats_names(posts):
    named = kpis.group_stats(posts, plain_names=False)
    assert named.columns == ["subreddit", "avg(score)", "avg(sentiment)", "avg(num_comments)"]
    assert resolve_column(named, "avg_sentiment") == "avg(score)"
    assert resolve_column(kpis.group_stats(posts), "avg_sentiment") == "avg_sentiment"


def test_missing_columns_are_null(posts, rows):
    assert rows(kpis.group_stats(posts.drop("num_comments").filter("id = 1"))) == [
        ("a", 10.0, 0.5, None)
    ]
    assert rows(kpis.global_kpis(posts.drop("score"))) == [(6, None, 0.125, 0)]


def test_mean_ranking_puts_missing_last(posts):
    ranked = kpis.mean_ranking(kpis.group_stats(posts)).collect()
    assert [r["subreddit"] for r in ranked] == [None, "a", "b"]


def test_global_kpis(posts, empty, rows):
    assert rows(kpis.global_kpis(posts, posts)) == [(6, 5.5, 0.125, 6)]
    assert rows(kpis.global_kpis(empty, empty)) == [(0, None, None, 0)]


def test_group_kpis_match_pandas(posts):
    frame = pd.DataFrame(POSTS, columns=posts.columns)
    for r in kpis.group_kpis(posts).collect():
        mine = frame[frame.subreddit == r["subreddit"]]
        assert r["n_posts"] == len(mine)
        assert r["max_score"] == mine.score.max()
        assert r["positive_pct"] == pytest.approx((mine.sentiment > 0).mean() * 100)
    assert kpis.group_kpis(posts).count() == 2


def test_sentiment_split(posts, empty, rows):
    share = 100 / 3
    got = {r["subreddit"]: tuple(r)[1:] for r in kpis.sentiment_split(posts, "subreddit").collect()}
    assert got["a"] == pytest.approx((1, 1, 1, share, share, share))
    assert got["b"] == (0, 0, 0, None, None, None)
    assert rows(kpis.sentiment_split(empty)) == [(0, 0, 0, None, None, None)]


def test_volume_and_groups(posts, rows):
    assert [tuple(r) for r in kpis.volume(posts).collect()] == [("a", 4), ("b", 1)]
    assert [r[0] for r in kpis.distinct_groups(posts).collect()] == ["a", "b"]


def test_authors_skip_missing_ones(posts, rows):
    assert rows(kpis.author_activity(posts)) == [("ann", 2), ("bob", 1), ("cat", 1)]
    assert ("None", 1) in rows(kpis.author_activity(posts, na_tokens=()))
    assert [tuple(r) for r in ranking.top_authors(posts, 2).collect()] == [("ann", 2), ("bob", 1)]
    per_group = ranking.top_authors(posts, 1, "subreddit")
    assert rows(per_group) == [("a", "ann", 2, 1)]


EVENTS = [
    ("a", "2024-01-01 00:10:00", 1.0),
    ("a", "2024-01-01 00:50:00", 3.0),
    ("a", "2024-01-02 00:05:00", NAN),
    ("b", "2024-01-02 13:00:00", 2.0),
    (None, "2024-01-03 05:00:00", 2.0),
    ("b", None, 2.0),
]


@pytest.fixture(scope="module")
def events(spark):
    df = spark.createDataFrame(EVENTS, "g string, ts string, x double")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_hourly(events, rows):
    hour = datetime(2024, 1, 1, 0)
    day2, late = datetime(2024, 1, 2, 0), datetime(2024, 1, 2, 13)
    assert rows(trends.hourly_volume(events, "ts", ["g"])) == sorted(
        [(hour, "a", 2), (day2, "a", 1), (late, "b", 1)], key=repr
    )
    assert trends.hourly_volume(events, "ts").count() == 4
    assert rows(trends.hourly_mean(events.filter("g = 'a'"), "ts", "x")) == sorted(
        [(hour, 2.0), (day2, None)], key=repr
    )


def test_hour_of_day(events, rows):
    got = rows(trends.hour_of_day_profile(events, "ts", "x", ["g"]))
    assert got == [("a", 0, 3, 2.0), ("b", 13, 1, 2.0)]


def test_daily(events, rows):
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    assert rows(trends.daily_volume(events, "ts", "g")) == sorted(
        [(one, "a", 2), (two, "a", 1), (two, "b", 1)], key=repr
    )
    want = sorted([(one, 2, 0), (two, 1, 1)], key=repr)
    assert rows(trends.daily_volume_matrix(events, "ts", "g"), "day", "a", "b") == want
    named = trends.daily_volume_matrix(events, "ts", "g", ["a", "b", "c"])
    assert rows(named, "day", "a", "b", "c") == [(*r, 0) for r in want]


def test_hours_add_up_to_the_rows(events):
    total = trends.hourly_volume(events, "ts").agg(F.sum("n")).first()[0]
    assert total == events.filter("ts IS NOT NULL").count()
