"""Session settings this library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; safe to set on a session that already exists.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole texts go to Python workers, each of which holds a batch or two as Arrow and as Python strings.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", memory: str = "8g", conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": "8",
        **(conf or {}),
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("murmura")
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
