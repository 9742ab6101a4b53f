"""Work on the arrays of one row in time that grows little faster than their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, although lambdas in it use the value for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Each element combined with all before it; null or empty arrays stay as they are.

    ``combine`` takes what comes before and after and must be associative. The
    distance doubles from round to round, so n elements take n log n steps;
    appending to an array one by one would take the square of n.
    """
    distances = F.array(*[F.lit(1 << i) for i in range(31)])

    def wider(found: Column, distance: Column) -> Column:
        return F.transform(
            found, lambda x, i: F.when(i >= distance, combine(F.get(found, i - distance), x)).otherwise(x)
        )

    return F.aggregate(
        distances, items, lambda found, d: F.when(d < F.size(found), wider(found, d)).otherwise(found)
    )


def text_pieces(text: Column) -> Column:
    """The text cut every ``PIECE`` code points, for ``between``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` up to ``end``, without a walk from the beginning of the text."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    near = F.array_join(F.transform(F.sequence(first, last), lambda i: F.get(pieces, i)), "")
    found = F.substring(near, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))
    return F.when(end > start, found).otherwise(F.lit(""))
