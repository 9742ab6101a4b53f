import pytest

from murmura.operators import cohorts as c

POSTS = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None), (None, "a")]
COMMENTS = [
    ("c1", 1, 5.0, 0.5, "one", "x"),
    ("c2", 2, 9.0, -0.5, "two", "y"),
    ("c3", 2, 9.0, None, "three", "y"),
    ("c4", 3, 1.0, float("nan"), "four", "x"),
    ("c5", 4, 99.0, 0.5, "five", "x"),
    ("c6", 77, 50.0, 0.5, "six", "x"),
    ("c7", None, 50.0, 0.5, "seven", "x"),
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, "id int, subreddit string").repartition(3)


@pytest.fixture(scope="module")
def comments(spark):
    return spark.createDataFrame(
        COMMENTS, "id string, post_id int, score double, sentiment double, body string, author string"
    ).repartition(3)


def test_cohort_ignores_copies_of_posts(posts, comments, rows):
    own = posts.filter("subreddit = 'a'")
    assert rows(c.cohort_comments(own, comments), "id") == [("c1",), ("c2",), ("c3",)]
    assert c.cohort_comments(own, comments).columns == comments.columns


def test_with_group(posts, comments, rows):
    got = dict(rows(c.with_group(comments, posts), "id", "subreddit"))
    want = {"c1": "a", "c2": "a", "c3": "a", "c4": "b", "c5": None, "c6": None, "c7": None}
    assert got == want
    tagged = c.with_group(comments, posts)
    assert c.with_group(tagged, posts) is tagged


def test_comment_volume(posts, comments):
    direct = c.comment_volume(c.with_group(comments, posts))
    joined = c.comment_volume(comments, posts)
    assert [tuple(r) for r in direct.collect()] == [("a", 3), ("b", 1)]
    assert [tuple(r) for r in joined.collect()] == [("a", 3), ("b", 1)]
    with pytest.raises(ValueError):
        c.comment_volume(comments)


def test_comment_kpis(posts, comments, rows):
    assert rows(c.comment_kpis(posts, comments)) == [("a", 3, 0.0), ("b", 1, None)]


def test_top_comments(posts, comments, rows):
    own = posts.filter("subreddit = 'a'")
    best = c.top_comments(own, comments, 2)
    assert [r["id"] for r in best.collect()] == ["c2", "c3"]
    assert best.columns == ["id", "body", "author", "score", "sentiment"]
    twice = comments.union(comments)
    assert [r["id"] for r in c.top_comments(own, twice, 3).collect()] == ["c2", "c2", "c3"]


def test_top_comments_per_group(posts, comments, rows):
    got = c.top_comments_per_group(posts, comments, 2)
    assert rows(got, "subreddit", "rank", "id", "body") == [
        ("a", 1, "c2", "two"),
        ("a", 2, "c3", "three"),
        ("b", 1, "c4", "four"),
    ]
    tagged = c.with_group(comments, posts)
    assert c.top_comments_per_group(posts, tagged, 2).count() == 3


def test_a_hot_post_counts_in_full(spark, rows):
    posts = spark.createDataFrame([(i, f"g{i % 3}") for i in range(30)], "id int, subreddit string")
    comments = spark.range(20000).selectExpr(
        "cast(id AS string) AS id", "if(id % 3 = 0, 7, cast(id % 30 AS int)) AS post_id", "0.5D AS sentiment"
    )
    want = {}
    for i in range(20000):
        post = 7 if i % 3 == 0 else i % 30
        want[f"g{post % 3}"] = want.get(f"g{post % 3}", 0) + 1
    assert rows(c.comment_kpis(posts, comments)) == [(g, n, 0.5) for g, n in sorted(want.items())]


@pytest.fixture
def shuffle_joins_with_low_skew_bounds(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_hot_post_is_split_in_row_level_joins(spark, shuffle_joins_with_low_skew_bounds):
    posts = spark.range(2000).selectExpr("id", "concat('g', id % 3) AS subreddit")
    comments = spark.range(200000).selectExpr(
        "id", "if(id % 3 = 0, 7, id % 2000) AS post_id", "uuid() AS body"
    )
    for df in (c.cohort_comments(posts, comments), c.with_group(comments, posts)):
        assert len(df.collect()) == 200000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
