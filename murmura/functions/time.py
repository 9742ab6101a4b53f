"""Time expressions. Results are zone-less UTC times whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds (number or text) to a UTC timestamp without zone."""
    interval = F.make_dt_interval(secs=seconds.try_cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + interval


def utc(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a UTC timestamp without zone.

    Takes zone-less timestamps as they are, timestamps with zone by their
    instant, and anything else as epoch seconds.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    if isinstance(kind, T.TimestampType):
        return epoch_to_utc(F.unix_micros(name).cast("decimal(20,0)") / F.lit(1000000))
    return epoch_to_utc(F.col(name))


def hour_bucket(ts: Column) -> Column:
    """Start of the hour. Keeps the type of ``ts``, unlike ``date_trunc``."""
    return F.window(ts, "1 hour").getField("start")


def with_dates(df: DataFrame, created: str = "created_utc") -> DataFrame:
    """Add ``date`` (timestamp), ``hour`` (0-23) and ``day`` (calendar date)."""
    if created not in df.columns:
        return df
    return (
        df.withColumn("date", utc(df, created))
        .withColumn("hour", F.hour("date"))
        .withColumn("day", F.to_date("date"))
    )
