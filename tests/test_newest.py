import random

import pytest

from murmura.operators.ranking import latest_n_per_group
from murmura.sources.tables import FolderStore
from murmura.streaming import newest

SCHEMA = "id long, subreddit string, created_utc long, title string"


def posts(seed, n):
    rng = random.Random(seed)
    groups = ["a", "b", "c", None]
    return [(seed * 1000 + i, rng.choice(groups), rng.randrange(500), f"t{i}") for i in range(n)]


@pytest.mark.parametrize("n", [1, 3, 50])
def test_merged_runs_equal_the_batch_query(spark, tmp_path, rows, n):
    store = FolderStore(spark, str(tmp_path))
    everything = []
    for number, size in enumerate([30, 0, 40, 5]):
        made = posts(number, size)
        everything += made
        run = spark.createDataFrame(made, SCHEMA)
        for _ in range(2):  # a repeated run changes nothing
            newest.merge_latest(store, "newest", run, number, n)
            want = latest_n_per_group(spark.createDataFrame(everything, SCHEMA), n).drop("rank")
            assert rows(newest.read_latest(store, "newest", run.schema)) == rows(want)


def test_nothing_before_the_first_run(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert newest.read_latest(FolderStore(spark, str(tmp_path)), "newest", schema).collect() == []


def test_files_that_arrive_late_take_their_place(spark, tmp_path, rows):
    store, arriving = FolderStore(spark, str(tmp_path / "tables")), str(tmp_path / "arriving")
    schema = spark.createDataFrame([], SCHEMA).schema
    everything = []
    for number in (3, 1, 2):
        made = posts(number, 25)
        everything += made
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(arriving)
        newest.catch_up_latest(stream, store, "newest", str(tmp_path / "progress"), 4)
        want = latest_n_per_group(spark.createDataFrame(everything, SCHEMA), 4).drop("rank")
        assert rows(newest.read_latest(store, "newest", schema)) == rows(want)
