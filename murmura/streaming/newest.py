"""The newest posts of every group, kept up to date run by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from murmura.operators.ranking import latest_n_per_group
from murmura.sources.tables import FolderStore

_NUMBER = "_number"


def _last(store: FolderStore, table: str, schema: StructType, before: int | None) -> tuple[DataFrame, str]:
    """The winners of the last merge, or of the last one before a number, and the slot that is free to write."""
    stored = StructType([*schema, StructField(_NUMBER, LongType())])
    best = None
    rows, free = store.spark.createDataFrame([], schema), "slot-0"
    for slot, other in (("slot-0", "slot-1"), ("slot-1", "slot-0")):
        kept = store.read_run(table, slot, stored)
        number = kept.agg(F.max(_NUMBER)).first()[0]
        if number is not None and (before is None or number < before) and (best is None or number > best):
            best, rows, free = number, kept.drop(_NUMBER), other
    return rows, free


def merge_latest(
    store: FolderStore,
    table: str,
    rows: DataFrame,
    number: int,
    n: int,
    by: str = "subreddit",
    ts: str = "created_utc",
    key: str = "id",
) -> None:
    """Merge run ``number`` into the ``n`` newest posts of every group.

    Reads the stored winners and the new rows, never the rows of earlier
    runs; rows that come late take their place all the same. Two slots are
    written in turn, so the storage is bounded, what stood before can be read
    until the new winners are complete, and a run that is repeated starts from
    the same winners again. Runs are numbered upwards, without gaps or with.
    """
    before, free = _last(store, table, rows.schema, number)
    merged = latest_n_per_group(before.unionByName(rows), n, by, ts, key).drop("rank")
    store.append(merged.withColumn(_NUMBER, F.lit(number).cast("long")), table, free)


def read_latest(store: FolderStore, table: str, schema: StructType) -> DataFrame:
    """The newest posts of every group as of the last merge; none before the first."""
    return _last(store, table, schema, None)[0]


def catch_up_latest(
    df: DataFrame,
    store: FolderStore,
    table: str,
    checkpoint: str,
    n: int,
    by: str = "subreddit",
    ts: str = "created_utc",
    key: str = "id",
) -> None:
    """Merge everything that has arrived, a run per micro-batch, then stop."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_latest(store, table, batch, number, n, by, ts, key)

    query = (
        df.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
