"""Rankings that shuffle keys first and fetch the wide columns of the winners afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.operators.ranking import top_k_per_group

FILTER_WORDS = 1 << 16
# Spark moves a condition only if nothing in it depends on the tasks, so bundles go by hash.
BUNDLES = 8


def _shifted(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def maybe_among(df: DataFrame, members: DataFrame, keys: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """Rows of ``df`` whose ``keys`` may be among ``members``; few others, none missing.

    A Bloom filter of ``words`` words of 64 bits, two bits a key. It is one
    value of that size however many members there are, and a condition on the
    keys alone, so Spark moves it down to where they are read and drops rows
    there, before any exchange. Beyond some ten members a word it lets more
    and more other rows pass.
    """
    h = F.xxhash64(*keys)
    word = F.pmod(F.shiftrightunsigned(h, 12), F.lit(words))
    bits = _shifted(h).bitwiseOR(_shifted(F.shiftrightunsigned(h, 6)))
    empty = df.sparkSession.range(words).select("id", F.lit(0).cast("long"))
    filled = members.select(word.alias("word"), bits.alias("bits")).union(empty)
    filled = filled.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    table = filled.agg(F.transform(ordered, lambda x: x["bits"]).alias("table")).scalar()
    return df.filter(F.get(table, word.cast("int")).bitwiseAND(bits) == bits)


def same_keys(df: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join with distinct ``winners`` on keys in which a missing value equals a missing value."""
    renamed = {key: f"_won_{key}" for key in keys}
    condition = F.lit(True)
    for key, other in renamed.items():
        condition = condition & F.col(key).eqNullSafe(F.col(other))
    return df.join(winners.withColumnsRenamed(renamed), condition).drop(*renamed.values())


def late_top_k_per_group(
    df: DataFrame,
    by: str,
    keys: Sequence[str],
    order: Sequence[Column],
    ties: Sequence[Column],
    k: int,
    found_by: Sequence[str] = ("id",),
    rank: str = "rank",
) -> DataFrame:
    """``top_k_per_group`` by ``order``, then ``ties``, without a shuffle of the losers' wide columns.

    ``order`` needs ``by`` and ``keys`` only, ``ties`` may need all columns.
    Keys are ranked by themselves first. Whatever the ties decide, the keys of
    the first ``k`` rows are the same, so rows with other keys lose; they are
    dropped by a filter on ``found_by``, the keys that tell rows apart, where
    they are read. The rest are ranked with their ties.
    """
    slim = df.select(*dict.fromkeys([by, *keys]))
    winners = top_k_per_group(slim, [by], order, k, parts=BUNDLES, part=F.hash(*keys)).select(by, *keys).distinct()
    near = maybe_among(df, winners, found_by)
    return top_k_per_group(same_keys(near, winners, [by, *keys]), [by], [*order, *ties], k, rank)
