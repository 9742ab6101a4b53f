from datetime import datetime

import pytest
from pyspark.sql import functions as F

from acceptance.queries import QUERIES
from murmura.operators.ranking import dedupe_by_id
from murmura.operators.scoring import process_posts
from murmura.schemas import POSTS_RAW
from murmura.sources.landing import write_landing
from murmura.sources.tables import FolderStore
from murmura.streaming import landing_stream as s


def raw(spark, *ids):
    return spark.createDataFrame(
        [(str(i), "t", "Good\nday", "1", "a", str(1700000000 + i), "s", "u", "1") for i in ids],
        POSTS_RAW,
    )


def test_new_files_are_processed_once(spark, tmp_path, rows):
    folder, table, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        arriving = s.stream_landing(spark, f"{folder}/*", POSTS_RAW)
        s.catch_up(process_posts(arriving), table, progress)
        return rows(spark.read.parquet(table), "id", "clean_body", "sentiment")

    write_landing(raw(spark, 1, 2), f"{folder}/one")
    assert run() == [("1", "good\nday", 0.5), ("2", "good\nday", 0.5)]
    assert len(run()) == 2
    write_landing(raw(spark, 3), f"{folder}/two")
    assert [r[0] for r in run()] == ["1", "2", "3"]


def test_copies_are_dropped_on_reading_and_late_rows_stay(spark, tmp_path, rows):
    folder, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    store = FolderStore(spark, str(tmp_path / "tables"))

    def run():
        s.catch_up_runs(s.stream_landing(spark, f"{folder}/*", POSTS_RAW), store, "posts", progress)
        return rows(dedupe_by_id(store.read("posts")), "id")

    write_landing(raw(spark, 100_000, 100_000, 200_000), f"{folder}/one")
    assert run() == [("100000",), ("200000",)]
    write_landing(raw(spark, 3, 200_000), f"{folder}/two")  # the first is more than a day older
    assert run() == [("100000",), ("200000",), ("3",)]


def test_hours_of_files_that_land_last_are_counted(spark, tmp_path, rows):
    folder, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    store = FolderStore(spark, str(tmp_path / "tables"))
    schema = "at timestamp_ntz, g string"

    def arrive(*times):
        df = spark.createDataFrame([(f"2024-01-01 {t}:00", "a") for t in times], "at string, g string")
        df.withColumn("at", F.col("at").cast("timestamp_ntz")).write.mode("append").parquet(folder)
        stream = s.stream_table(spark, folder, spark.createDataFrame([], schema).schema)
        s.catch_up_runs(stream, store, "hours", progress, lambda batch: s.hourly_counts(batch, "at", "g"))
        return rows(s.total_counts(store.read("hours"), "g"))

    def hour(h):
        return datetime(2024, 1, 1, h)

    assert arrive("05:10", "05:50") == [(hour(5), "a", 2)]
    assert arrive("00:59", "05:30") == [(hour(0), "a", 1), (hour(5), "a", 3)]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def as_file(df, path):
    df.toPandas().to_parquet(path, coerce_timestamps="us")


@pytest.mark.parametrize("parts", [0, 1, 3])
def test_streams_read_a_table_that_is_a_file_or_a_folder_of_files(spark, tmp_path, rows, parts):
    texts = [(i, f"one {w}", "en", "7", 8) for i, w in enumerate(["with", "that", "none", None, "with"])]
    times = [(i, datetime(2024, 1, 1, i % 2, i), 1, "a", 0.5, "") for i in range(5)]
    for name, made, schema in (("documents", texts, DOCUMENTS), ("events", times, EVENTS)):
        df, path = spark.createDataFrame(made, schema), f"{tmp_path}/{name}.parquet"
        df.repartition(parts).write.parquet(path) if parts else as_file(df, path)
    got = rows(QUERIES["stream_clean_posts"](spark, str(tmp_path)), "id", "sentiment", "score")
    assert got == [(0, 0.5, 8.0), (1, -0.5, 8.0), (2, 0.0, 8.0), (3, 0.0, 8.0), (4, 0.5, 8.0)]
    hours = QUERIES["stream_hourly_volume"](spark, str(tmp_path))
    assert [r[1:] for r in rows(hours, "hour_start", "event_type", "n")] == [("a", 3), ("a", 2)]


def test_a_stream_of_an_empty_table_is_empty(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["stream_clean_posts"](spark, str(tmp_path)).collect() == []


def test_a_named_table_keeps_its_partitions_and_takes_each_file_once(spark, tmp_path, rows):
    folder, schema = str(tmp_path / "day=9"), "id long, day int"

    def run():
        arriving = s.stream_named_table(spark, folder, spark.createDataFrame([], schema).schema, "t.parquet")
        s.catch_up(arriving, str(tmp_path / "out"), str(tmp_path / "progress"))
        return rows(spark.read.parquet(str(tmp_path / "out")), "id", "day")

    df = spark.createDataFrame([(1, 1), (2, 2)], schema)
    df.write.partitionBy("day").parquet(f"{folder}/t.parquet")
    df.write.parquet(f"{folder}/other.parquet")
    assert run() == run() == [(1, 1), (2, 2)]
    spark.createDataFrame([(3, 2)], schema).write.mode("append").partitionBy("day").parquet(f"{folder}/t.parquet")
    assert run() == [(1, 1), (2, 2), (3, 2)]
