"""Bounded samples to fit a model on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOTS = 1 << 30


def bounded_sample(df: DataFrame, most: int, lot: Column, *ties: str) -> DataFrame:
    """At most ``most`` rows, those with the least ``lot`` (a hash), so that reruns agree.

    The rows are counted first, so that all but about as many as are wanted
    go where they are read, and few are left to be ordered.
    """
    n = df.count()
    share = F.pmod(lot, F.lit(_LOTS))
    if n > most:
        df = df.filter(share < int(_LOTS * (most + 5 * most**0.5) / n) + 1)
    return df.orderBy(share, *ties).limit(most)
