"""Mergeable quantile sketches, and exact quantiles that read their values twice.

A KLL sketch per group says within which values a wanted rank lies, but for a
small error. One pass then counts everything by zones between such values and
keeps single values inside the zones in question only, so a few rows in a
thousand are shuffled, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from murmura.operators.skew import with_group_row
from murmura.sources.scratch import stage

K = 2048
PARTS = 8


def rank_error(k: int) -> float:
    """By how much of its total a sketch misses a rank, at 99 % confidence."""
    return 2.296 / k**0.9723


def quantile_sketches(values: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """A sketch of column ``v`` per group, as ``(*by, total, low, high, sketch)``; a group without values has none.

    Sketches of parts of a table, such as the runs of a job, can be kept and
    merged, so that they need not be read again.
    """
    found = values.groupBy(*by).agg(
        F.count("v").alias("total"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.kll_sketch_agg_double("v", k).alias("sketch"),
    )
    return found.filter("total > 0")


def merged_sketches(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One sketch per group from sketches of parts."""
    return parts.groupBy(*by).agg(
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def sketched_quantiles(sketches: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Approximate quantiles, as ``(*by, total, q)``; the least and the greatest value are exact."""
    inner = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    exact = {0.0: F.col("low"), 1.0: F.col("high")}
    q = [exact.get(float(p), F.get(inner, F.lit(i))) for i, p in enumerate(probs)]
    return sketches.select(*by, "total", F.array(*q).alias("q"))


def _brackets(sketches: DataFrame, by: Sequence[str], probs: Sequence[float], error: float, parts: int) -> DataFrame:
    """Per group the bounds of each wanted rank, and all cut points: ``(*by, total, low, high, lows, highs, cuts)``."""
    bounds = [(max(0.0, p - error), min(1.0, p + error)) for p in probs]
    shares = sorted({low + (high - low) * i / parts for low, high in bounds for i in range(parts + 1)})
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(share) for share in shares]))
    at = {share: F.get("_found", F.lit(i)) for i, share in enumerate(shares)}
    at |= {0.0: F.col("low"), 1.0: F.col("high")}
    return sketches.withColumn("_found", found).select(
        *by,
        "total",
        "low",
        "high",
        F.array(*[at[low] for low, _ in bounds]).alias("lows"),
        F.array(*[at[high] for _, high in bounds]).alias("highs"),
        F.array_sort(F.array_distinct(F.array(*[at[share] for share in shares]))).alias("cuts"),
    )


def _zoned(values: DataFrame, brackets: DataFrame, by: Sequence[str], n_probs: int, n_cuts: int) -> DataFrame:
    """Rows per group, zone and, inside a bracket, value: ``(*by, total, zone, v, n)``.

    Zone 2 i lies below cut i, zone 2 i + 1 is the cut itself. Other zones
    than these and those in a bracket are counted without their values.
    """
    present = values.filter("v IS NOT NULL")
    if by:
        placed = with_group_row(present, brackets, by)
    else:
        row = brackets.select(F.struct(*brackets.columns)).scalar()
        placed = present.withColumn("_row", row).select("v", "_row.*")
    placed = placed.withColumn("place", F.lit(0))
    step = 1 << (n_cuts - 1).bit_length()
    while step:
        below = f"place + if(coalesce(get(cuts, place + {step - 1}) < v, false), {step}, 0)"
        placed = placed.withColumn("place", F.expr(below))
        step //= 2
    inside = " OR ".join(f"(v > get(lows, {i}) AND v < get(highs, {i}))" for i in range(n_probs))
    on_cut = "coalesce(get(cuts, place) = v, false)"
    cells = placed.selectExpr(
        *[f"`{name}`" for name in by],
        "total",
        f"2 * place + if({on_cut}, 1, 0) AS zone",
        f"if({on_cut} OR {inside}, v, null) AS v",
    )
    return cells.groupBy(*by, "total", "zone", "v").agg(F.count(F.lit(1)).alias("n"))


def bracketed_quantiles(
    values: DataFrame, by: Sequence[str], probs: Sequence[float], k: int = K, parts: int = PARTS
) -> DataFrame:
    """Exact quantiles of column ``v`` with linear interpolation, as ``(*by, total, q)``.

    Reads ``values`` twice, which therefore should be a stored table of groups
    and values: for a sketch per group, and for the counts. Sketches differ
    from run to run, so their cut points are stored before they are used. A
    bracket is three times as wide as the sketch's error; should a rank lie
    outside nevertheless, the counts tell, and they are taken once more with
    brackets of four times the width. ``parts`` divides a bracket, so that the
    values of a very large group are sorted in pieces.
    """
    by, inner = list(by), sorted({float(p) for p in probs} - {0.0, 1.0})
    sketches = stage(quantile_sketches(values, by, k), "sketches")
    ends = sketches.select(*by, "total", "low", "high")
    if not inner:
        q = [F.col("high") if p else F.col("low") for p in map(float, probs)]
        return ends.select(*by, "total", F.array(*q).alias("q"))
    error = 3 * rank_error(k)
    while True:
        brackets = stage(_brackets(sketches, by, inner, error, parts), "brackets")
        cells = stage(_zoned(values, brackets, by, len(inner), len(inner) * (parts + 1)), "zones")
        below = [f"floor((total - 1) * {p}D) + 1" for p in inner]
        above = [f"ceil((total - 1) * {p}D) + 1" for p in inner]
        part = [f"((total - 1) * {p}D - floor((total - 1) * {p}D))" for p in inner]
        earlier = W.partitionBy(*by).orderBy("zone").rowsBetween(W.unboundedPreceding, -1)
        zones = cells.groupBy(*by, "total", "zone").agg(F.sum("n").alias("zone_n"), F.count("v").alias("known"))
        wanted = (
            zones.withColumn("before", F.coalesce(F.sum("zone_n").over(earlier), F.lit(0)))
            .withColumn("ranks", F.expr(f"array_distinct(array({', '.join(below + above)}))"))
            .withColumn("ranks", F.expr("filter(ranks, r -> r > before AND r <= before + zone_n)"))
            .filter("size(ranks) > 0")
        )
        if wanted.filter("known = 0").isEmpty():
            break
        error *= 4
    names = [f"`{name}`" for name in by]
    through = W.partitionBy(*by, "zone").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = (
        cells.join(wanted.select(*by, "zone", "before", "ranks"), [*by, "zone"])
        .withColumn("upto", F.col("before") + F.sum("n").over(through))
        .selectExpr(*names, "v", "explode(filter(ranks, r -> r > upto - n AND r <= upto)) AS rank")
    )
    found = hits.groupBy(*by).agg(F.expr("map_from_entries(collect_list(struct(rank, v)))").alias("at"))
    joined = ends.join(found, by) if by else ends.withColumn("at", found.scalar())
    value = {p: f"at[{lo}] + (at[{hi}] - at[{lo}]) * {t}" for p, lo, hi, t in zip(inner, below, above, part)}
    value |= {0.0: "low", 1.0: "high"}
    return joined.selectExpr(*names, "total", f"array({', '.join(value[float(p)] for p in probs)}) AS q")
