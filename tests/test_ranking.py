import random

import pytest
from pyspark.sql import functions as F

from murmura.operators import ranking as r


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        group = "hot" if i % 2 else f"g{rng.randrange(40)}"
        score = rng.choice([None, float("nan"), float(rng.randrange(30))])
        rows.append((i, group, score, str(rng.randrange(5, 2000)), f"t{i}"))
    rows += [(9001, None, 1e9, "9", "no group")]
    return spark.createDataFrame(
        rows, "id int, subreddit string, score double, created_utc string, title string"
    ).repartition(13)


def brute(posts, key, k):
    groups = {}
    for row in posts.collect():
        if row["subreddit"] is not None:
            groups.setdefault(row["subreddit"], []).append(row)
    return {
        (g, n + 1, row["id"])
        for g, rows in groups.items()
        for n, row in enumerate(sorted(rows, key=key)[:k])
    }


def by_score(row):
    s = row["score"]
    missing = s is None or s != s
    return (missing, 0 if missing else -s, row["id"])


@pytest.mark.parametrize("parts", [0, 2, 32])
def test_top_k_matches_brute_force(posts, parts):
    order = [F.desc_nulls_last("score"), F.asc("id")]
    clean = posts.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    got = r.top_k_per_group(clean, ["subreddit"], order, 4, parts=parts)
    assert {(x["subreddit"], x["rank"], x["id"]) for x in got.collect()} == brute(posts, by_score, 4)


def test_top_posts_per_group(posts):
    got = r.top_posts_per_group(posts, 5)
    assert {(x["subreddit"], x["rank"], x["id"]) for x in got.collect()} == brute(posts, by_score, 5)
    assert got.columns == ["subreddit", "id", "title", "score", "rank"]


def test_top_posts(posts):
    best = [x["id"] for x in r.top_posts(posts, 5).collect()]
    assert best == [x["id"] for x in sorted(posts.collect(), key=by_score)[:5]]


def test_latest_orders_epoch_text_as_numbers(posts):
    got = r.latest_n_per_group(posts, 3)
    want = brute(posts, lambda x: (-int(x["created_utc"]), x["id"]), 3)
    assert {(x["subreddit"], x["rank"], x["id"]) for x in got.collect()} == want


def test_latest_is_idempotent(posts):
    once = r.latest_n_per_group(posts, 3)
    twice = r.latest_n_per_group(once, 3)
    keys = ["subreddit", "rank", "id"]
    assert sorted(once.select(keys).collect()) == sorted(twice.select(keys).collect())


def test_first_k_per_parent(spark, rows):
    df = spark.createDataFrame(
        [(p, o) for p in range(3) for o in range(p * 3)] + [(None, 0)], "post_id int, ordinal int"
    )
    got = r.first_k_per_parent(df.repartition(4), 2)
    assert rows(got) == [(1, 0, 1), (1, 1, 2), (2, 0, 1), (2, 1, 2)]
    assert r.first_k_per_parent(df, 0).count() == 0


def test_dedupe_by_id(spark, rows):
    copies = [(7, load, f"v{load}") for load in range(500)]
    df = spark.createDataFrame(copies + [(8, 1, "x"), (None, 1, "y"), (None, 1, "y")], "id int, load int, v string")
    got = r.dedupe_by_id(df.repartition(5), latest=[F.desc("load")])
    assert rows(got) == sorted([(7, 499, "v499"), (8, 1, "x"), (None, 1, "y"), (None, 1, "y")], key=repr)


def test_equally_late_copies_are_resolved_by_content(spark):
    df = spark.createDataFrame([(1, 9, v) for v in "cab"], "id int, load int, v string")
    found = {
        r.dedupe_by_id(df.repartition(n), latest=[F.desc("load")]).first()["v"] for n in (1, 2, 5)
    }
    assert found == {"a"}
