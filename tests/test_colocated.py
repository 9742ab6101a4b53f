import pytest

from murmura.operators import cohorts
from murmura.sources.colocated import write_colocated


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("colocated")
    posts = spark.range(3000).selectExpr("id", "concat('g', id % 7) AS subreddit").union(
        spark.createDataFrame([(5, "g5"), (None, "g1")], "id long, subreddit string")
    )
    comments = spark.range(20_000).selectExpr(
        "id", "if(id % 50 = 0, null, id % 4000) AS post_id", "if(id % 2 = 0, 0.5D, -0.5D) AS sentiment"
    )
    yield (
        posts,
        comments,
        write_colocated(posts, "colocated_posts", "id", 6, f"{folder}/posts"),
        write_colocated(comments, "colocated_comments", "post_id", 6, f"{folder}/comments"),
    )
    spark.sql("DROP TABLE colocated_posts")
    spark.sql("DROP TABLE colocated_comments")


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_cohorts_of_colocated_tables_shuffle_nothing(tables, no_broadcast, rows):
    posts, comments, own, replies = tables
    found = cohorts.cohort_comments(own, replies)
    assert "SortMergeJoin" in plan(found) and "Exchange" not in plan(found)
    assert rows(found) == rows(cohorts.cohort_comments(posts, comments))


def test_kpis_of_colocated_tables_shuffle_groups_only(tables, no_broadcast, rows):
    posts, comments, own, replies = tables
    found = cohorts.comment_kpis(own, replies)
    said = plan(found)
    join = said.index("SortMergeJoin")
    assert "Exchange" not in said[join:] and "Exchange" in said[:join]
    assert rows(found) == rows(cohorts.comment_kpis(posts, comments))


def test_writing_again_replaces(spark, tmp_path):
    for n in (100, 10):
        table = write_colocated(spark.range(n), "colocated_again", "id", 3, str(tmp_path / "again"))
        assert table.count() == n
    assert len(table.inputFiles()) <= 3
    spark.sql("DROP TABLE colocated_again")
