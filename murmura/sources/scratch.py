"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given.

    Without either there is no scratch table. A folder of the driver's own
    machine is invisible to the executors and lost with the machine, so none
    is ever made up here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new scratch table and return a frame that reads it.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer the true size, so that a later join broadcasts the table only
    when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
