import random

import pytest
from pyspark.sql import functions as F

from murmura.operators import trends
from murmura.operators.order import numbered


@pytest.mark.parametrize("n, lots", [(0, 4), (1, 4), (300, 1), (300, 16), (3000, 1024)])
def test_places_follow_the_order(spark, n, lots):
    rng = random.Random(n)
    names = {"".join(rng.choices("rabé/Z", k=rng.randint(0, 9))) for _ in range(n)}
    made = [(name,) for name in names] * 2
    df = spark.createDataFrame(made, "g string").repartition(3)
    got = {r["g"]: r["place"] for r in numbered(df, "g", lots=lots).collect()}
    assert got == {name: i for i, name in enumerate(sorted(names, key=lambda s: s.encode()))}


def test_a_missing_name_and_numbers(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "g string")
    assert {r["g"]: r["place"] for r in numbered(df, "g").collect()} == {None: 0, "a": 1, "b": 2}
    assert numbered(spark.range(5000).withColumnRenamed("id", "g"), "g").filter("g = place").count() == 5000


def test_pages_hold_all_groups_without_a_pivot(spark):
    """More groups than a pivot takes."""
    rows = spark.range(60_000).selectExpr(
        "concat('g', lpad(id % 12000, 6, '0')) AS g", "86400L * (id % 2 + if(id < 30000, 0, 5)) AS ts"
    )
    spark.sparkContext.setJobGroup("planning", "planning")
    pages = trends.daily_volume_pages(rows, "ts", "g", groups_per_page=500)
    spark.sparkContext.setJobGroup("", "")
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    got = pages.collect()
    assert {r["page"] for r in got} == set(range(24)) and all(len(r["groups"]) == len(r["n"]) == 500 for r in got)
    assert sum(sum(r["n"]) for r in got) == 60_000
    cells = {(str(r["day"]), g): n for r in got for g, n in zip(r["groups"], r["n"]) if n}
    daily = {(str(r["day"]), r["g"]): r["n"] for r in trends.daily_volume(rows, "ts", "g").collect()}
    assert cells == daily


def test_missing_cells_are_zero(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("a", 86400), (None, 0), ("c", None)], "g string, ts long")
    got = trends.daily_volume_pages(df, "ts", "g").orderBy("day").select("page", F.col("day").cast("string"), "groups", "n")
    assert [tuple(r) for r in got.collect()] == [
        (0, "1970-01-01", ["a", "b"], [1, 1]),
        (0, "1970-01-02", ["a", "b"], [1, 0]),
    ]


@pytest.mark.parametrize("per_range, lots", [(1, 4), (20, 64), (10**6, 8)])
def test_running_totals(spark, per_range, lots):
    from murmura.operators.order import running_totals

    rng = random.Random(per_range)
    keys = {(rng.choice("abx"), "".join(rng.choices("pqé😀", k=rng.randint(0, 5)))) for _ in range(400)}
    made = [(g if g != "x" else None, key, rng.randint(1, 9)) for g, key in keys]
    df = spark.createDataFrame(made, "g string, key string, w int").repartition(4)
    got = {(r["g"], r["key"]): r["upto"] for r in running_totals(df, ["g"], "key", "w", "upto", lots, per_range).collect()}
    want, totals = {}, {}
    for g, key, w in sorted(made, key=lambda row: row[1].encode()):
        totals[g] = want[g, key] = totals.get(g, 0) + w
    assert got == want


def test_a_hot_conversation_without_turns_is_spread(spark):
    """All its messages without a turn, a third of them equal: many tasks, pages of bounded size."""
    from murmura.operators import order, prompts

    n = 60_000
    text = F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 8, "0")))
    talk = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), text.alias("text")
    )
    said = prompts.render_transcripts(talk, page_turns=1000, spread=True).collect()
    assert sorted(r["page"] for r in said) == list(range(-60, 0))
    ordered = [m for r in sorted(said, key=lambda r: -r["page"]) for m in r["transcript"].split("\n\n")]
    want = sorted(["User:\nsame"] * (n // 3) + [f"User:\nt{i:08d}" for i in range(n) if i % 3])
    assert ordered == want
    distinct = talk.groupBy("conv_id", "text").agg(F.count("*").alias("n"))
    ranged = order.running_totals(distinct, ["conv_id"], "text", "n", per_range=1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 0.6 * sum(sizes)
