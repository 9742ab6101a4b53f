"""The batch transformations on landed files as they arrive.

Files are taken in by a checkpointed query that stops when it has caught up,
so it can run on a schedule and goes on after a lost executor or driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from murmura.operators.trends import hourly_volume
from murmura.sources.landing import CSV_READ
from murmura.sources.tables import FolderStore


def stream_landing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """New CSV files of a landing folder."""
    return spark.readStream.schema(schema).options(**CSV_READ).csv(path)


def stream_table(
    spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet"
) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)


def stream_named_table(spark: SparkSession, folder: str, schema: StructType, name: str) -> DataFrame:
    """New Parquet files of one table of a folder, which may be a file or itself a folder of files.

    A stream takes a file only by a glob; ``basePath`` keeps the partition
    columns that folders below the table stand for.
    """
    folder = folder.rstrip("/")
    last = f"{name[:-1]}[{name[-1]}]"
    return spark.readStream.schema(schema).option("basePath", folder).parquet(f"{folder}/{last}")


def hourly_counts(batch: DataFrame, ts: str, by: str) -> DataFrame:
    """Rows per hour and group of one micro-batch."""
    return hourly_volume(batch, ts, [by])


def total_counts(counts: DataFrame, by: str) -> DataFrame:
    """Rows per hour and group of all micro-batches so far: partial counts added up."""
    return counts.groupBy("hour_start", by).agg(F.sum("n").alias("n"))


def catch_up_runs(
    df: DataFrame,
    store: FolderStore,
    table: str,
    checkpoint: str,
    each: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Append everything that has arrived to a stored table, a run per micro-batch, then stop.

    A micro-batch that is repeated after a failure replaces its own run. There
    is no watermark, so nothing is too late: hours that were counted before
    get a further partial count, and copies of an id that arrive any time
    later are removed on reading, by ``total_counts`` and ``dedupe_by_id``.
    """

    def append(batch: DataFrame, number: int) -> None:
        store.append(each(batch), table, f"batch-{number}")

    query = (
        df.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def catch_up(df: DataFrame, table: str, checkpoint: str) -> None:
    """Append everything that has arrived to a Parquet table, then stop."""
    query = (
        df.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
