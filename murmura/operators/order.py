"""Numbers in a total order, without ordering everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _ranged(rows: DataFrame, key: str, lots: int) -> DataFrame:
    """Rows with ``_range``, the number of ``_cuts`` below their key; no cuts make one range."""
    ranged = rows.withColumn("_range", F.lit(0))
    step = 1 << (lots - 1).bit_length()
    while step:
        below = f"_range + if(coalesce(get(_cuts, _range + {step - 1}) < `{key}`, false), {step}, 0)"
        ranged = ranged.withColumn("_range", F.expr(below))
        step //= 2
    return ranged.drop("_cuts")


def numbered(names: DataFrame, key: str, place: str = "place", lots: int = 1024) -> DataFrame:
    """Distinct rows of ``key`` and their places, from 0, in its order; a missing one comes first.

    At most ``lots`` names, those with the least hash of their lot, cut the
    names into ranges; rows per range are counted and added up, and each range
    numbers its own. The cuts depend on the names alone.
    """
    own = names.select(key).distinct()
    lot = F.pmod(F.hash(key), F.lit(lots))
    cuts = own.groupBy(lot.alias("_lot")).agg(F.min_by(key, F.xxhash64(key)).alias("_cut"))
    sorted_cuts = cuts.agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
    ranged = _ranged(own.withColumn("_cuts", sorted_cuts.scalar()), key, lots)
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(W.partitionBy("_range").orderBy(F.asc_nulls_first(key)))
    placed = ranged.withColumn("_local", local).join(sizes, "_range")
    return placed.select(key, (F.col("_before") + F.col("_local") - 1).alias(place))


def running_totals(
    rows: DataFrame,
    by: Sequence[str],
    key: str,
    weight: str,
    upto: str = "upto",
    lots: int = 256,
    per_range: int = 50_000,
) -> DataFrame:
    """``rows`` with the sum of ``weight`` from the group's first key up to their own.

    Keys are texts, distinct in their group. A group of more than
    ``per_range`` rows is cut into ranges, at most ``lots``, that are summed up
    apart and then add what the earlier ranges hold. The cuts are keys with
    the least hash of their lot, so they depend on the keys alone; of a very
    long key the first 1,000 characters stand for it.
    """
    by = list(by)
    start = F.substring(key, 1, 1000)
    dealt = rows.select(*by, start.alias("_cut"), F.pmod(F.hash(key), F.lit(lots)).alias("_lot"), F.xxhash64(key).alias("_h"))
    sample = dealt.groupBy(*by, "_lot").agg(
        F.min_by("_cut", "_h").alias("_cut"), F.min("_h").alias("_h"), F.count(F.lit(1)).alias("_n")
    )
    wanted = F.ceil(F.sum("_n") / per_range).cast("int") - 1
    chosen = F.slice(F.sort_array(F.collect_list(F.struct("_h", "_cut"))), F.lit(1), wanted)
    cuts = sample.groupBy(*by).agg(F.sort_array(F.transform(chosen, lambda x: x["_cut"])).alias("_cuts"))
    cut = rows.join(cuts.filter("size(_cuts) > 0"), by, "left").withColumn("_start", start)
    ranged = _ranged(cut, "_start", lots).drop("_start")
    earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_range").agg(F.sum(weight).alias("_total"))
    before = totals.withColumn("_before", F.sum("_total").over(earlier)).filter("_before IS NOT NULL").drop("_total")
    within = W.partitionBy(*by, "_range").orderBy(key).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.withColumn(upto, F.sum(weight).over(within)).join(before, [*by, "_range"], "left")
    total = F.col(upto) + F.coalesce("_before", F.lit(0))
    return local.withColumn(upto, total).select(*rows.columns, upto)
