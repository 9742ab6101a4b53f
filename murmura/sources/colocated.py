"""Catalog tables laid out by a key, so that joins and groupings on it shuffle nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_colocated(
    df: DataFrame, table: str, key: str, buckets: int, path: str | None = None
) -> DataFrame:
    """Write ``df`` as a catalog table in ``buckets`` files by a hash of ``key``, each in order, and read it.

    Two tables with the same number of buckets, one by post id and the other
    by the id of the post that a comment is on, are joined bucket by bucket:
    no exchange, no sort. Choose the number so that a bucket of the larger
    table fits a task, and keep it for all tables of a key. The rows are
    shuffled once, when they are written. A bucket is read by one task, so a
    single key with a great share of the rows is better served by a plain
    table, whose joins adaptive execution can split.

    ``path`` is the table's folder, or the catalog's own place for tables.
    Repeating the write replaces the table.
    """
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
