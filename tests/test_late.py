import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.operators import cohorts, late, prompts
from murmura.operators.ranking import top_k_per_group


def shuffled_bytes(spark, df):
    group = f"measured-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    found = df.collect()
    spark.sparkContext.setJobGroup("", "")
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return found, sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages)


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """20,000 rows with a kilobyte of text each that no codec makes small."""
    path = str(tmp_path_factory.mktemp("wide"))
    noise = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{i}")), 256) for i in range(16)])
    rows = spark.range(20_000, numPartitions=6).withColumn("body", noise)
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_texts_of_losers_are_not_shuffled(spark, wide):
    posts = spark.range(400).selectExpr("id", "concat('g', id % 20) AS subreddit")
    comments = wide.selectExpr("id", "id % 400 AS post_id", "body", "cast(id * 7919 % 10007 AS double) AS score")
    found, size = shuffled_bytes(spark, cohorts.top_comments_per_group(posts, comments, 3, late=True))
    assert len(found) == 60 and all(len(r["body"]) == 1024 for r in found)
    assert size < 2_500_000  # keys, and the texts of 60 winners, out of 20 million bytes


def test_texts_of_old_posts_are_not_shuffled(spark, wide):
    posts = wide.selectExpr(
        "id", "concat('g', id % 20) AS subreddit", "'t' AS title", "body", "1D AS score", "id * 7919 % 10007 AS created_utc"
    )
    found, size = shuffled_bytes(spark, prompts.prompt_context(posts, 2))
    assert len(found) == 20 and all(r["n_rows"] == 2 for r in found)
    assert size < 2_500_000


def test_the_filter_moves_below_a_join(spark, wide):
    """The texts are filtered where they are read, though the order comes from another table."""
    times = spark.range(20_000).selectExpr("id", "concat('g', id % 20) AS subreddit", "id AS created_utc", "1D AS score")
    posts = wide.withColumn("title", F.lit("t")).hint("shuffle_hash").join(times, "id")
    found, size = shuffled_bytes(spark, prompts.prompt_context(posts, 2))
    assert len(found) == 20
    assert size < 4_000_000


def test_filter_lets_members_pass(spark):
    members = spark.range(0, 3000, 3).selectExpr("id", "cast(id AS string) AS name")
    rows = spark.range(30_000).selectExpr("id", "cast(id AS string) AS name")
    passed = {r["id"] for r in late.maybe_among(rows, members, ["id", "name"]).collect()}
    wanted = set(range(0, 3000, 3))
    assert wanted <= passed and len(passed) < len(wanted) + 30
    tiny = late.maybe_among(rows, members, ["id"], words=4)
    assert tiny.columns == rows.columns and wanted <= {r["id"] for r in tiny.collect()}
    nulls = spark.createDataFrame([(None, "a"), (1, None)], "id long, name string")
    assert late.maybe_among(nulls, nulls, ["id", "name"]).count() == 2
    assert late.maybe_among(rows, members.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("k", [1, 4, 50])
def test_late_ranking_equals_the_plain_one(spark, rows, k):
    rng = np.random.default_rng(k)
    made = []
    for i in range(400):
        id = None if i % 11 == 0 else int(rng.integers(40))
        at = [None, 1.0, 2.0, float(rng.integers(5))][int(rng.integers(4))]
        made.append((id, [None, "a", "b", "c"][int(rng.integers(4))], at, f"text {int(rng.integers(6))}"))
    df = spark.createDataFrame(made, "id int, g string, at double, body string").repartition(5)
    order, ties = [F.desc_nulls_last("at"), F.asc("id")], [F.asc("body")]
    plain = top_k_per_group(df, ["g"], [*order, *ties], k)
    got = late.late_top_k_per_group(df, "g", ["at", "id"], order, ties, k)
    names = ["g", "rank", "id", "at", "body"]
    assert rows(got, *names) == rows(plain, *names)


@pytest.mark.parametrize("k", [1, 3, 40])
def test_late_comments_equal_the_others(spark, rows, k):
    rng = np.random.default_rng(k)
    made = []
    for i in range(500):
        id = None if i % 13 == 0 else f"c{rng.integers(90)}"
        score = [None, float("nan"), 1.0, float(rng.integers(4))][int(rng.integers(4))]
        post = None if i % 17 == 0 else int(rng.integers(25))
        made.append((id, post, f"text {rng.integers(3)}", score))
    comments = spark.createDataFrame(made, "id string, post_id int, body string, score double").repartition(4)
    posts = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(20)] + [(1, "c"), (1, "b")], "id int, subreddit string")
    plain = cohorts.top_comments_per_group(posts, comments, k)
    late_ones = cohorts.top_comments_per_group(posts, comments, k, late=True)
    assert rows(late_ones) == rows(plain)
