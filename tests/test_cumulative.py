import pytest

from murmura.operators.kpis import group_stats, stats_of_states, stats_states
from murmura.plans.job import cumulative_stats, run_job
from murmura.schemas import STATS
from murmura.sources.landing import write_landing
from murmura.sources.tables import FolderStore

RAW = "id string, title string, body string, score string, author string, created_utc string, subreddit string, url string, num_comments string"


def land(spark, folder, *posts):
    rows = [(str(i), "t", body, score, "u", "0", group, "x", n) for i, body, score, group, n in posts]
    write_landing(spark.createDataFrame(rows, RAW), f"{folder}/posts.csv")
    return str(folder)


def test_statistics_cover_all_runs(spark, tmp_path, rows):
    store = FolderStore(spark, str(tmp_path / "tables"))
    assert cumulative_stats(store).collect() == [] and cumulative_stats(store).schema == STATS
    first = land(spark, tmp_path / "one", (1, "good", "4", "a", "1"), (2, "bad", "x", "a", None), (3, "", "9", None, "2"))
    second = land(spark, tmp_path / "two", (4, "bad", "1", "a", "5"), (5, "good", "2", "b", "7"))
    run_job(spark, first, store, run="one")
    assert rows(cumulative_stats(store)) == rows(store.read("stats"))
    for _ in range(2):
        run_job(spark, second, store, run="two")
    assert rows(cumulative_stats(store)) == rows(group_stats(store.read("posts")))
    assert rows(store.read("stats")) == [("a", 1.0, -0.5, 5.0), ("b", 2.0, 0.5, 7.0)]


@pytest.mark.parametrize("columns", [["g"], ["g", "score"]])
def test_states_of_missing_columns_and_values(spark, rows, columns):
    df = spark.createDataFrame([("a", float("nan")), ("a", None), ("b", 2.0)], "g string, score double")
    found = stats_of_states(stats_states(df.select(*columns), "g"), "g")
    assert rows(found) == rows(group_stats(df.select(*columns), "g"))
