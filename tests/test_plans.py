from pyspark.sql import functions as F

from murmura.functions import keyword_sentiment
from murmura.operators import cohorts, distributions, keywords, kpis, prompts, ranking, trends
from murmura.operators.scoring import lexicon_sentiment, process_posts
from murmura.schemas import COMMENTS_RAW, POSTS, POSTS_RAW, STATS
from murmura.sources.landing import in_groups, read_posts, write_landing
from murmura.sources.tables import CatalogStore, FolderStore
from murmura.plans import dashboard
from murmura.plans.job import JobResult, main, run_job

import pytest

RAW = [
    (str(i), f"title {i}", "a good day" if i % 3 else "a bad day", str(i), f"u{i % 4}",
     str(1700000000 + 1000 * i), "ab"[i % 2], "u", str(i % 5))
    for i in range(40)
]
REPLIES = [(f"c{i}", str(i % 50), "good" if i % 2 else "so so", "x", str(i), "0", "z") for i in range(90)]


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    write_landing(spark.createDataFrame(RAW, POSTS_RAW), f"{folder}/posts.csv")
    write_landing(spark.createDataFrame(REPLIES, COMMENTS_RAW), f"{folder}/comments.csv")
    return folder


def test_job(spark, landing, tmp_path, rows):
    store = FolderStore(spark, str(tmp_path))
    assert run_job(spark, landing, store, run="r1") == JobResult(40, 90)
    assert store.read("posts").schema == POSTS
    assert store.read("stats").schema == STATS
    stats = rows(store.read("stats"))
    assert rows(kpis.group_stats(store.read("posts"))) == stats
    # A repeated run changes nothing, a new run adds its rows; statistics are of the last run.
    run_job(spark, landing, store, run="r1")
    assert store.read("posts").count() == 40
    run_job(spark, landing, store, run="r2")
    assert store.read("posts").count() == 80 and store.read("comments").count() == 180
    assert rows(store.read("stats")) == stats


def test_job_to_the_catalog(spark, landing, rows):
    store = CatalogStore(spark, prefix="job_")
    run_job(spark, landing, store)
    run_job(spark, landing, store)
    assert store.read("posts").count() == 80
    assert rows(store.read("stats")) == rows(kpis.group_stats(store.read("posts")))
    store.reset({"posts": POSTS, "comments": POSTS, "stats": STATS})


def test_job_treats_posts_and_comments_apart(spark, tmp_path):
    folder, store = str(tmp_path / "in"), FolderStore(spark, str(tmp_path / "out"))
    write_landing(spark.createDataFrame([], POSTS_RAW), f"{folder}/posts.csv")
    assert run_job(spark, folder, store) == JobResult(0, 0)
    write_landing(spark.createDataFrame(REPLIES, COMMENTS_RAW), f"{folder}/comments.csv")
    assert run_job(spark, folder, store) == JobResult(0, 90)


def test_job_command(spark, landing, tmp_path):
    main([landing, "--folder", str(tmp_path), "--run", "x", "--int-mode", "lenient"])
    assert FolderStore(spark, str(tmp_path)).read("posts").count() == 40
    with pytest.raises(Exception):
        main([str(tmp_path / "nowhere"), "--folder", str(tmp_path)])


@pytest.fixture(scope="module")
def processed(spark, landing):
    return process_posts(read_posts(spark, f"{landing}/posts.csv"))


@pytest.fixture(scope="module")
def replies(spark):
    df = spark.createDataFrame(REPLIES, COMMENTS_RAW)
    return df.withColumn("score", F.col("score").cast("double")).withColumn(
        "sentiment", keyword_sentiment(F.col("body"))
    )


def test_market_view(processed, replies, rows):
    views = dashboard.market_view(processed, replies.drop("subreddit"))
    assert rows(views["kpis"])[0][0] == 40
    assert rows(views["comment_volume"]) == [("a", 40), ("b", 40)]
    assert views["sentiment_vs_score"].count() == 40
    assert views["sentiment_boxes"].count() == 2
    assert [r["subreddit"] for r in views["mean_sentiment"].collect()] == ["a", "b"]
    assert "comment_volume" not in dashboard.market_view(processed)


def test_group_view(processed, replies, rows):
    views = dashboard.group_view(processed, "a", replies)
    assert rows(views["kpis"])[0][:3] == ("a", 20, 38.0)
    assert views["volume_by_hour"].agg(F.sum("n")).first()[0] == 20
    assert [r["id"] for r in views["top_posts"].collect()] == ["38", "36", "34", "32", "30"]
    assert rows(views["comment_kpis"])[0][0] == views["top_comments"].count() * 4
    assert sum(rows(views["sentiment_split"])[0][:3]) == 20
    for view in views.values():
        view.collect()


def test_report(processed, rows):
    views = dashboard.report(processed)
    assert views["top_posts"].count() == 10
    assert views["sentiment_histogram"].agg(F.sum("n")).first()[0] == 40
    for view in views.values():
        view.collect()


def test_everything_is_total_on_no_rows(spark):
    none = spark.createDataFrame([], POSTS)
    for view in {**dashboard.market_view(none), **dashboard.report(none)}.values():
        view.collect()
    for view in dashboard.group_view(none, "a").values():
        view.collect()


# --- shapes of the physical plans -------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, processed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "posts")
    processed.withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(kpis.group_kpis(stored.filter(in_groups(["a"]))))
    assert "EqualTo(subreddit,a)" in text.split("PushedFilters:")[1]
    assert "ReadSchema: struct<score:double,subreddit:string,sentiment:double>" in text, text


def test_processing_needs_no_python(processed):
    text = plan(processed)
    assert "Python" not in text and "Exchange" not in text


def test_limits_apply_before_the_shuffle(stored):
    text = plan(ranking.top_posts_per_group(stored))
    assert text.count("row_number(), 5, Partial") == 2
    assert "TakeOrderedAndProject" in plan(ranking.top_posts(stored))


def test_no_operator_multiplies_rows(stored, replies):
    frames = [
        kpis.global_kpis(stored, replies),
        trends.hourly_volume(stored, "at", ["subreddit"]),
        distributions.histogram(stored),
        distributions.histogram(stored, by=["subreddit"]),
        distributions.binned_scatter(stored),
        distributions.box_stats(stored, whisker="tukey"),
        keywords.top_keywords(stored, by="subreddit"),
        lexicon_sentiment(stored, {"good": 1.0}),
        cohorts.comment_kpis(stored, replies.drop("subreddit")),
        prompts.build_prompts(prompts.prompt_context(stored), {"ask": "What?"}, "Role."),
    ]
    for df in frames:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_lexicon_scores_need_no_shuffle(stored):
    text = plan(lexicon_sentiment(stored, {"good": 1.0}))
    assert "Exchange" not in text and "Join" not in text


def test_a_hot_post_is_split(spark, stored):
    """One post holds 60 percent of the comments: its join is split over several tasks."""
    thresholds = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in thresholds}
    for key, value in thresholds.items():
        spark.conf.set(key, value)
    try:
        posts = spark.range(100).selectExpr("id", "concat('g', id % 7) AS subreddit")
        comments = spark.range(20000, numPartitions=6).selectExpr(
            "id", "if(id % 10 < 6, 5, id % 100) AS post_id", "rand(3) AS score", "uuid() AS body"
        )
        for df in (cohorts.with_group(comments, posts), cohorts.cohort_comments(posts, comments)):
            df.write.format("noop").mode("overwrite").save()
            found = df.groupBy("post_id").count()
            assert {r["count"] for r in found.collect() if r["post_id"] == 5} == {12000}
            final = df.select("body")
            final.collect()
            assert "skew=true" in plan(final)
        best = cohorts.top_comments_per_group(posts, comments, 3)
        got = best.collect()
        assert len(got) == 21
        joined = [line for line in plan(best).splitlines() if "SortMergeJoin" in line]
        assert len(joined) <= 2
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_building_a_plan_runs_no_job(spark, stored, replies):
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    distributions.box_stats(stored, whisker="tukey")
    distributions.box_outliers(stored)
    distributions.histogram(stored, by=["subreddit"])
    keywords.top_keywords(stored, stopwords=spark.createDataFrame([("good",)], "word string"))
    lexicon_sentiment(stored, {"good": 1.0})
    cohorts.top_comments(stored, replies)
    cohorts.top_comments_per_group(stored, replies.drop("subreddit"))
    prompts.build_prompts(prompts.prompt_context(stored), {"ask": "What?"}, "Role.")
    spark.sparkContext.setJobGroup("", "")
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []


def test_more_groups_than_a_broadcast_may_have(spark):
    """One group or winner more than the bound of ``skew.small``: every one has its result."""
    values = spark.range(100_001).selectExpr("id AS g", "cast(id AS double) AS x")
    assert distributions.histogram(values, "x", 2, ["g"]).count() == 200_002
    assert distributions.box_stats(values, "x", ["g"]).filter("n = 1 AND median = g").count() == 100_001
    tukey = distributions.box_stats(values, "x", ["g"], whisker="tukey")
    assert tukey.filter("whisker_low = g AND whisker_high = g").count() == 100_001
    posts = spark.range(100_005).selectExpr(
        "id", "id % 6667 AS subreddit", "id AS created_utc", "'t' AS title", "'b' AS body", "1D AS score"
    )
    assert prompts.prompt_context(posts, 15).filter("n_rows = 15").count() == 6667
    groups = spark.range(10_001).selectExpr("id", "id AS subreddit")
    replies = spark.range(100_010).selectExpr("id", "id % 10001 AS post_id", "'b' AS body", "1D AS score")
    assert cohorts.top_comments_per_group(groups, replies, 10).count() == 100_010


def test_a_hot_group_is_split_when_its_summary_is_not_broadcast(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        values = spark.range(20000, numPartitions=6).selectExpr(
            "if(id % 10 < 6, 5, id % 100) AS g", "cast(id AS double) AS x"
        )
        counted = distributions.histogram(values, "x", 4, ["g"])
        assert sum(r["n"] for r in counted.collect()) == 20000
        assert "skew=true" in plan(counted)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
