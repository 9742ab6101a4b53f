"""Lenient casts: bad text becomes NULL, never an error, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(value: Column) -> Column:
    """NaN as NULL. Spark holds NaN > 0 to be true and lets it poison averages."""
    return F.nanvl(value, F.lit(None).cast("double"))


def to_double(value: Column) -> Column:
    return nan_to_null(value.try_cast("double"))


def to_int(value: Column, mode: str = "strict") -> Column:
    """Integer cast. ``strict`` turns '2.0' into NULL, ``lenient`` goes through double."""
    if mode == "strict":
        return value.try_cast("int")
    if mode == "lenient":
        return to_double(value).try_cast("int")
    raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` with NaN as NULL when its type can hold NaN."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return nan_to_null(F.col(name)) if floating else F.col(name)


def in_order_desc(df: DataFrame, name: str) -> Column:
    """Descending sort key for column ``name`` with missing values last."""
    return F.desc_nulls_last(number(df, name))
