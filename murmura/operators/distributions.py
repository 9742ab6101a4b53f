"""Quantiles, box-plot figures, histograms and binned scatter plots.

Exact and without ever holding a group in one task. The operators read the
value column more than once, with aggregates that combine before they shuffle;
what a pass needs to know of its group is a summary, which Spark broadcasts
below its own threshold. Then only the rows that may hold a wanted rank are
shuffled, spread by group and range; with a larger summary all values are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from murmura.functions import number
from murmura.operators.sketches import bracketed_quantiles
from murmura.operators.skew import with_group_row
from murmura.sources.scratch import stage

_QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _values(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Groups and values, as ``(*by, v)``; a missing value is NULL, a missing group goes."""
    kept = df.select(*by, number(df, value).alias("v"))
    for key in by:
        kept = kept.filter(F.col(key).isNotNull())
    return kept


def _names(by: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in by]


def _with_summary(rows: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the summary of their group; without groups the summary is one row."""
    if by:
        return with_group_row(rows, summary, by)
    return rows.withColumn("_summary", summary.select(F.struct(*summary.columns)).scalar()).select(
        *rows.columns, "_summary.*"
    )


def _cuts(values: DataFrame, by: Sequence[str], lots: int, per_range: int) -> DataFrame:
    """Cut points per group that divide its values, as ``(*by, cuts, total)``.

    The values are dealt by hash into lots, and the one with the least hash
    of each lot may become a cut: a random sample, but always the same one. A
    task that is run again after an executor was lost must not come to other
    cuts than the rest of the query. (On a number the hash is one to one, so
    there are no ties.) A group gets as many cuts as make ranges of about
    ``per_range`` rows, so its number of ranges grows with the group.
    """
    dealt = values.withColumns({"hash": F.xxhash64("v"), "lot": F.pmod(F.hash("v"), F.lit(lots))})
    sample = dealt.groupBy(*by, "lot").agg(
        F.min_by("v", "hash").alias("cut"), F.min("hash").alias("hash"), F.count("v").alias("n")
    )
    ranked = F.sort_array(F.collect_list(F.when(F.col("cut").isNotNull(), F.struct("hash", "cut"))))
    total = F.sum("n")
    wanted = F.ceil(total / per_range).cast("int") - 1
    chosen = F.transform(F.slice(ranked, F.lit(1), F.greatest(wanted, F.lit(0))), lambda x: x["cut"])
    return sample.groupBy(*by).agg(F.sort_array(chosen).alias("cuts"), total.alias("total")).filter("total > 0")


def _range(steps: int) -> list[str]:
    """One column per step of a binary search for the number of ``cuts`` below ``v``.

    Spark keeps a projection that is used twice apart, so the steps are
    computed once each, in generated code.
    """
    widths = []
    while steps:
        widths.append(f"range + if(coalesce(get(cuts, range + {steps - 1}) < v, false), {steps}, 0)")
        steps //= 2
    return widths


def _placed(values: DataFrame, cuts: DataFrame, by: Sequence[str], lots: int) -> DataFrame:
    placed = _with_summary(values.filter("v IS NOT NULL"), cuts, by).withColumn("range", F.lit(0))
    for step in _range(1 << (lots - 1).bit_length()):
        placed = placed.withColumn("range", F.expr(step))
    return placed


def exact_quantiles(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    probs: Sequence[float],
    lots: int = 1024,
    per_range: int = 50_000,
) -> DataFrame:
    """Exact quantiles with linear interpolation, as ``(*by, total, q)`` with ``q`` an array.

    Cut points divide the values of a group into ranges of about ``per_range``
    rows, at most ``lots`` ranges. Rows per range tell which ranges hold the
    wanted ranks, and only rows of those ranges are shuffled and sorted, after
    equal values have been counted. The cut points decide how evenly the work
    is spread, never what the result is.
    """
    by = list(by)
    values = _values(df, value, by)
    placed = _placed(values, _cuts(values, by, lots, per_range), by, lots)

    # Ranks count from 1; a quantile lies between the two ranks next to it.
    below = [f"floor((total - 1) * {float(p)}D) + 1" for p in probs]
    above = [f"ceil((total - 1) * {float(p)}D) + 1" for p in probs]
    part = [f"((total - 1) * {float(p)}D - floor((total - 1) * {float(p)}D))" for p in probs]
    ranks = f"array_distinct(array({', '.join(below + above)}))"

    earlier = W.partitionBy(*by).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    targets = (
        placed.groupBy(*by, "range", "total")
        .agg(F.count(F.lit(1)).alias("range_n"))
        .withColumn("before", F.coalesce(F.sum("range_n").over(earlier), F.lit(0)))
        .selectExpr(
            *_names(by),
            "range",
            "before",
            f"filter({ranks}, r -> r > before AND r <= before + range_n) AS ranks",
        )
        .filter("size(ranks) > 0")
    )
    in_range = W.partitionBy(*by, "range").orderBy("v")
    through = in_range.rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = (
        placed.join(targets, [*by, "range"])
        .groupBy(*by, "range", "total", "before", "ranks", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.col("before") + F.sum("n").over(through))
        .selectExpr(
            *_names(by),
            "total",
            "v",
            "explode(filter(ranks, r -> r > upto - n AND r <= upto)) AS rank",
        )
    )
    found = hits.groupBy(*by).agg(
        F.max("total").alias("total"),
        F.expr("map_from_entries(collect_list(struct(rank, v)))").alias("at"),
    )
    q = [f"at[{lo}] + (at[{hi}] - at[{lo}]) * {t}" for lo, hi, t in zip(below, above, part)]
    return found.selectExpr(*_names(by), "total", f"array({', '.join(q)}) AS q")


def quantiles(
    df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float], k: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, as ``(*by, total, q)``, by way of sketches of size ``k``.

    Groups and values are stored first, so ``df`` is read once.
    """
    size = {"k": k} if k else {}
    return bracketed_quantiles(stage(_values(df, value, by), "values"), by, probs, **size)


def _box(values: DataFrame, by: Sequence[str], store: bool, **cutting: int) -> DataFrame:
    names = ("low", "q1", "median", "q3", "high")
    if store:
        quartiles = bracketed_quantiles(values, by, _QUARTILES, **cutting)
    else:
        quartiles = exact_quantiles(values, "v", by, _QUARTILES, **cutting)
    return quartiles.selectExpr(
        *_names(by), "total AS n_total", *[f"q[{i}] AS {name}" for i, name in enumerate(names)]
    )


def _read_once(df: DataFrame, value: str, by: Sequence[str], store: bool) -> DataFrame:
    """Groups and values, stored in the shared folder if wanted."""
    values = _values(df, value, by)
    return stage(values, "values") if store else values


def _with_fences(
    values: DataFrame, by: Sequence[str], reach: float, store: bool, **cutting: int
) -> DataFrame:
    """Values with the quartiles of their group, and whether they lie beyond the fences."""
    box = _box(values, by, store, **cutting)
    fenced = _with_summary(values.filter("v IS NOT NULL"), box, by)
    low = f"q1 - {float(reach)}D * (q3 - q1)"
    high = f"q3 + {float(reach)}D * (q3 - q1)"
    return fenced.withColumns(
        {
            "beyond_low": F.expr(f"v < {low}"),
            "beyond_high": F.expr(f"v > {high}"),
        }
    )


def box_stats(
    df: DataFrame,
    value: str = "sentiment",
    by: Sequence[str] = ("subreddit",),
    whisker: str = "minmax",
    reach: float = 1.5,
    store: bool = False,
    **cutting: int,
) -> DataFrame:
    """Box-plot figures per group.

    ``minmax`` draws the whiskers to the extremes. ``tukey`` draws them to the
    furthest value within ``reach`` inter-quartile ranges of the box and
    counts the rows beyond as outliers; that takes one more pass over the
    values, with partial aggregates only.

    ``store`` reads ``df`` once: groups and values are stored in the shared
    folder and read twice from there, by way of sketches (see ``sketches``).
    Without, no job runs yet, but ``df`` is read several times. ``cutting``
    goes to ``bracketed_quantiles`` or ``exact_quantiles``.
    """
    if whisker not in ("minmax", "tukey"):
        raise ValueError(f"whisker must be 'minmax' or 'tukey', not {whisker!r}")
    by = list(by)
    values = _read_once(df, value, by, store)
    if whisker == "minmax":
        return _box(values, by, store, **cutting).withColumnsRenamed(
            {"n_total": "n", "low": "whisker_low", "high": "whisker_high"}
        )
    # An interpolated quartile may lie beyond every value inside the fence,
    # and then the whisker ends at the box.
    return (
        _with_fences(values, by, reach, store, **cutting)
        .groupBy(*by, "n_total", "q1", "median", "q3")
        .agg(
            F.expr("min(if(beyond_low, null, v))").alias("least"),
            F.expr("max(if(beyond_high, null, v))").alias("most"),
            F.expr("count_if(beyond_low OR beyond_high)").alias("n_outliers"),
        )
        .selectExpr(
            *_names(by),
            "n_total AS n",
            "least(least, q1) AS whisker_low",
            "q1",
            "median",
            "q3",
            "greatest(most, q3) AS whisker_high",
            "n_outliers",
        )
    )


def box_outliers(
    df: DataFrame,
    value: str = "sentiment",
    by: Sequence[str] = ("subreddit",),
    reach: float = 1.5,
    store: bool = False,
    **cutting: int,
) -> DataFrame:
    """The values beyond the Tukey fences with their number of rows."""
    by = list(by)
    values = _read_once(df, value, by, store)
    beyond = _with_fences(values, by, reach, store, **cutting).filter("beyond_low OR beyond_high")
    return beyond.groupBy(*by, F.col("v").alias(value)).agg(F.count(F.lit(1)).alias("n"))


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of the equal-width bin, the last one closed on the right.

    A range of a single value is widened by one half on either side. A
    missing value has no bin.
    """
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, 1.0).otherwise(high - low)
    index = F.least(F.floor((x - start) / width * bins), F.lit(bins - 1))
    return F.when(x.isNotNull(), index).cast("int")


def histogram(
    df: DataFrame, value: str = "sentiment", bins: int = 20, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per equal-width bin over the range of the values, empty bins included.

    Per group with ``by``, each over its own range. The bins come from one
    conditional count each, so no join is needed to fill in the empty ones.
    """
    by = list(by)
    values = _values(df, value, by)
    span = values.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    if by:
        span = span.filter("lo IS NOT NULL")
    binned = _with_summary(values, span, by)
    index = _bin(F.col("v"), F.col("lo"), F.col("hi"), bins)
    cells = ", ".join(f"coalesce(count_if(bin = {i}), 0L)" for i in range(bins))
    summed = (
        binned.withColumn("bin", index)
        .groupBy(*by)
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.expr(f"array({cells})").alias("cells"))
    )
    start = F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    width = F.when(F.col("lo") == F.col("hi"), 1.0).otherwise(F.col("hi") - F.col("lo")) / bins
    return summed.select(
        *by, start.alias("start"), width.alias("width"), F.posexplode("cells").alias("bin", "n")
    ).select(
        *by,
        "bin",
        (F.col("start") + F.col("width") * F.col("bin")).alias("bin_low"),
        (F.col("start") + F.col("width") * (F.col("bin") + 1)).alias("bin_high"),
        "n",
    )


def scatter_rows(df: DataFrame, by: str = "subreddit") -> DataFrame:
    """The points of a scatter plot of sentiment against score, one per post."""
    wanted = ["title", by, "score", "sentiment"]
    return df.select(*[c for c in wanted if c in df.columns])


def binned_scatter(
    df: DataFrame,
    x: str = "sentiment",
    y: str = "score",
    by: str | None = "subreddit",
    bins: int = 20,
) -> DataFrame:
    """Rows per cell of a ``bins`` x ``bins`` grid: a scatter plot that fits any table size."""
    keys = [] if by is None else [by]
    kept = df.filter(F.col(by).isNotNull()) if keys else df
    kept = kept.select(*keys, number(df, x).alias("x"), number(df, y).alias("y"))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    span = kept.agg(
        *[f(F.when(both, F.col(c))).alias(f"{f.__name__}_{c}") for c in "xy" for f in (F.min, F.max)]
    )
    ranged = kept.withColumn("span", span.select(F.struct(*span.columns)).scalar())
    cells = [
        _bin(F.col(c), F.col(f"span.min_{c}"), F.col(f"span.max_{c}"), bins).alias(f"{c}_bin")
        for c in "xy"
    ]
    counted = ranged.select(*keys, *cells).groupBy(*keys, "x_bin", "y_bin")
    complete = F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull()
    return counted.agg(F.count_if(complete).alias("n")).filter(F.col("n") > 0)
