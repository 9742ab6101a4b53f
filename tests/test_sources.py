from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from murmura.schemas import COMMENTS_RAW, POSTS, POSTS_RAW, STATS
from murmura.sources import landing, scratch, tables

POSTS_ROWS = [
    ("1", 'He said "hi", ok', 'two\nlines \\" end', "3.5", "ann", "1700000000.0", "s", "u", "2.0"),
    ("2", "no body", None, "abc", "None", "1700000001.0", None, "u", None),
    ("3", "  padded  ", "tab\there 中 \U0001f600", "nan", "bob", "x", "s", "u,v", "7"),
    ("4", '"', ",", "1", "bob", "x", "s", "\\", "7"),
]


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(POSTS_ROWS, POSTS_RAW)


def test_landing_round_trip(spark, posts, tmp_path, rows):
    path = str(tmp_path / "posts.csv")
    assert landing.write_landing(posts.repartition(3), path) == 4
    assert rows(landing.read_posts(spark, path)) == sorted(POSTS_ROWS, key=repr)


def test_reads_what_pandas_writes(spark, tmp_path, rows):
    path = tmp_path / "posts.csv"
    pd.DataFrame(POSTS_ROWS, columns=POSTS_RAW.names).to_csv(path, index=False)
    assert rows(landing.read_posts(spark, str(path))) == sorted(POSTS_ROWS, key=repr)


def test_columns_by_header(spark, posts, tmp_path, rows):
    path = str(tmp_path / "posts.csv")
    landing.write_landing(posts.select("title", "id"), path)
    assert landing.read_landing(spark, path).columns == ["title", "id"]
    with pytest.raises(Exception, match="CSV header is not equal"):
        landing.read_posts(spark, path).collect()


def test_landing_is_replaced(spark, posts, tmp_path):
    path = str(tmp_path / "posts.csv")
    landing.write_landing(posts, path)
    assert landing.write_landing(posts.limit(0), path, skip_empty=True) == 0
    assert landing.read_posts(spark, path).count() == 4
    assert landing.write_landing(posts.limit(1), path) == 1
    assert landing.read_posts(spark, path).count() == 1
    landing.clear_landing(spark, path, POSTS_RAW)
    assert landing.read_posts(spark, path).isEmpty()


def test_missing_comments(spark, tmp_path):
    path = str(tmp_path / "none.csv")
    assert landing.read_comments(spark, path).schema == COMMENTS_RAW
    assert landing.read_comments(spark, path).isEmpty()
    with pytest.raises(AnalysisException):
        landing.read_comments(spark, path, missing_ok=False)
    with pytest.raises(AnalysisException):
        landing.read_posts(spark, path)


def test_group_lists(posts, rows):
    assert landing.parse_groups(" a, b ,c") == ["a", "b", "c"]
    assert rows(posts.filter(landing.in_groups("x, s")), "id") == [("1",), ("3",), ("4",)]
    assert landing.preview(posts, 2).count() == 2


def test_combine_matches_columns_by_name(posts, rows):
    swapped = posts.select(*reversed(posts.columns))
    assert rows(landing.combine_landings(posts, swapped)) == sorted(POSTS_ROWS * 2, key=repr)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_folder_store(spark, tmp_path, rows):
    store = tables.FolderStore(spark, str(tmp_path / "store"))
    schema = numbers(spark).schema
    assert store.read("t", schema).isEmpty()
    with pytest.raises(AnalysisException):
        store.read("t")
    assert rows(store.append(numbers(spark, 1), "t", "r1")) == [(1,)]
    assert rows(store.append(numbers(spark, 2), "t", "r2")) == [(2,)]
    assert rows(store.read("t")) == [(1,), (2,)]
    store.append(numbers(spark, 2), "t", "r2")
    assert rows(store.read("t")) == [(1,), (2,)]
    store.append(numbers(spark, 2), "t")
    assert rows(store.read("t", schema)) == [(1,), (2,), (2,)]
    with pytest.raises(ValueError):
        store.append(numbers(spark, 2), "t", "../r3")
    store.replace(numbers(spark, 5), "s")
    assert rows(store.replace(numbers(spark, 6), "s")) == [(6,)]
    store.reset({"t": schema, "s": schema})
    assert store.read("t", schema).isEmpty() and store.read("s").isEmpty()
    store.append(numbers(spark, 9), "t", "r4")
    assert rows(store.read("t")) == [(9,)]
    store.reset({"t": schema})
    assert store.read("t").isEmpty()


def test_catalog_store(spark, rows):
    store = tables.CatalogStore(spark, prefix="cs_")
    schema = numbers(spark).schema
    assert store.read("t", schema).isEmpty()
    assert rows(store.append(numbers(spark, 1), "t", "r1")) == [(1,)]
    assert rows(store.append(numbers(spark, 2, 3), "t", "r2")) == [(2,), (3,)]
    store.append(numbers(spark, 2), "t", "r2")
    assert rows(store.read("t")) == [(1,), (2,)]
    store.replace(numbers(spark, 5), "s")
    assert rows(store.replace(numbers(spark, 6), "s")) == [(6,)]
    assert rows(tables.run_sql(spark, "SELECT max(x) AS x FROM cs_t")) == [(2,)]
    store.reset({"t": schema, "s": schema, "never": schema})
    assert not spark.catalog.tableExists("cs_t")
    assert store.read("s", schema).isEmpty()


def test_jdbc_options(spark):
    store = tables.JdbcStore(spark, "jdbc:x:y", {"user": "u"}, prefix="p_", connections=4)
    assert store.write_options("posts") == {
        "user": "u",
        "url": "jdbc:x:y",
        "dbtable": "p_posts",
        "numPartitions": "4",
        "batchsize": "10000",
    }
    parts = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert store.read_options({"query": "SELECT 1"}, parts) == {
        "user": "u",
        "url": "jdbc:x:y",
        "query": "SELECT 1",
        **parts,
    }


def test_table_or_empty(spark):
    assert tables.table_or_empty(spark, "no_such_table", STATS).schema == STATS
    with pytest.raises(AnalysisException):
        tables.run_sql(spark, "SELECT nonsense FROM no_such_table")


def test_previews(spark):
    empty = spark.createDataFrame([], POSTS)
    assert tables.processed_preview(empty).columns == ["title", "clean_body", "sentiment", "score"]
    df = spark.range(5000)
    assert tables.comments_sample(df).count() == 5000
    assert [r[0] for r in tables.comments_sample(df, 2, ["id"]).collect()] == [0, 1]


def test_snapshot_holds_until_refreshed(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshot = tables.Snapshot(spark)

    def load():
        return spark.read.parquet(path)

    numbers(spark, 1).write.parquet(path)
    snapshot.refresh(held=load())
    assert spark.table("held").count() == 1
    numbers(spark, 2).write.mode("append").parquet(path)
    assert snapshot["held"].count() == 1
    snapshot.refresh(held=load())
    assert spark.table("held").count() == 2
    numbers(spark, 3).write.mode("overwrite").parquet(path)
    assert snapshot["held"].count() == 2
    snapshot.refresh(held=load())
    assert spark.table("held").count() == 1


def test_stage_gives_true_sizes(spark, rows):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    staged = scratch.stage(df, "sizes")
    assert rows(staged) == rows(df)
    plan = spark.range(10**9).join(staged, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_scratch_needs_a_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_dir(spark) == folder
    nothing = SimpleNamespace(get=lambda key, default: default)
    bare = SimpleNamespace(conf=nothing, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        scratch.scratch_dir(bare)
    bare.sparkContext.getCheckpointDir = lambda: "hdfs:///given/"
    assert scratch.scratch_dir(bare) == "hdfs:///given"


def test_frames_of_ad_hoc_sql_are_no_views(spark, rows):
    spark.range(7).createOrReplaceTempView("mine")
    found = tables.run_sql(spark, "SELECT count(*) AS n FROM {mine}", {"mine": spark.range(3)})
    assert rows(found) == [(3,)]
    assert spark.table("mine").count() == 7


def test_jdbc_appends_keep_no_runs(spark):
    store = tables.JdbcStore(spark, "jdbc:x:y")
    with pytest.raises(ValueError):
        store.append(spark.range(1), "t", "run-1")


class Cause:
    """What a driver's exception looks like from Python."""

    def __init__(self, state, cause=None):
        self.state, self.cause = state, cause

    def getSQLState(self):
        return self.state

    def getCause(self):
        return self.cause

    def getClass(self):
        return self

    def getName(self):
        return "java.sql.SQLException" if self.state else "java.lang.RuntimeException"


def test_a_missing_jdbc_table_is_told_by_its_state():
    error = RuntimeError()
    error.java_exception = Cause(None, Cause("42P01"))
    assert tables._is_missing_table(error)
    error.java_exception = Cause(None, Cause("28000"))
    assert not tables._is_missing_table(error)
