import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.operators import distributions, sketches


def frame(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(8)
    return {
        "hot": np.concatenate([rng.pareto(0.5, 6000), np.full(4000, 0.25)]),
        "ties": rng.integers(-1, 2, 700) / 2,
        "even": rng.random(3000),
        "two": [1.0, 4.0],
        "one": [3.5],
        "flat": [2.0] * 90,
    }


@pytest.mark.parametrize("k, parts", [(8, 1), (32, 4), (2048, 8)])
def test_bracketed_quantiles_are_exact(spark, groups, k, parts):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0, 0.5]
    got = sketches.bracketed_quantiles(frame(spark, groups), ["g"], probs, k, parts).collect()
    assert {r["g"] for r in got} == set(groups)
    for r in got:
        np.testing.assert_allclose(r["q"], np.quantile(groups[r["g"]], probs), rtol=1e-12)
        assert r["total"] == len(groups[r["g"]])


def test_a_missed_bracket_is_widened(spark, groups, monkeypatch):
    monkeypatch.setattr(sketches, "rank_error", lambda k: 1e-6)
    got = sketches.bracketed_quantiles(frame(spark, {"even": groups["even"]}), ["g"], [0.3, 0.5], 8).first()
    np.testing.assert_allclose(got["q"], np.quantile(groups["even"], [0.3, 0.5]), rtol=1e-12)


def test_quantiles_without_groups_and_of_nothing(spark, groups):
    df = frame(spark, groups)
    everything = np.concatenate([np.asarray(v, float) for v in groups.values()])
    got = sketches.bracketed_quantiles(df, [], [0, 0.1, 0.9]).first()
    np.testing.assert_allclose(got["q"], np.quantile(everything, [0, 0.1, 0.9]), rtol=1e-12)
    assert sketches.bracketed_quantiles(df.limit(0), ["g"], [0.5]).collect() == []
    assert sketches.bracketed_quantiles(df.limit(0), [], [0.5]).collect() == []
    missing = df.limit(3).withColumn("v", F.lit(None).cast("double"))
    assert sketches.bracketed_quantiles(missing, ["g"], [0.5, 1]).collect() == []


def test_sketches_of_parts_can_be_merged(spark, groups):
    df = frame(spark, groups)
    parts = df.withColumn("run", F.spark_partition_id())
    kept = sketches.quantile_sketches(parts, ["g", "run"])
    merged = sketches.merged_sketches(kept, ["g"])
    for r in sketches.sketched_quantiles(merged, ["g"], [0.0, 0.5, 1.0]).collect():
        values = np.sort(np.asarray(groups[r["g"]], float))
        assert r["total"] == len(values) and (r["q"][0], r["q"][2]) == (values[0], values[-1])
        low, high = (np.searchsorted(values, r["q"][1], side) / len(values) for side in ("left", "right"))
        assert low - 0.01 <= 0.5 <= high + 0.01 or len(values) <= 2


def test_few_values_are_shuffled(spark, groups, tmp_path):
    rng = np.random.default_rng(1)
    spark.createDataFrame([("hot", float(v)) for v in rng.normal(size=40_000)], "g string, v double").repartition(4).write.parquet(str(tmp_path / "v"))
    values = spark.read.parquet(str(tmp_path / "v"))
    brackets = sketches._brackets(sketches.quantile_sketches(values, ["g"]), ["g"], [0.25, 0.5, 0.75], 0.005, 4)
    zones = sketches._zoned(values, brackets, ["g"], 3, 15)
    assert zones.agg(F.sum("n")).first()[0] == 40_000
    assert zones.count() < 40_000 * 0.06


@pytest.mark.parametrize("whisker", ["minmax", "tukey"])
def test_stored_boxes_equal_the_others(spark, groups, rows, whisker):
    df = frame(spark, groups).withColumnRenamed("v", "x")
    stored = distributions.box_stats(df, "x", ["g"], whisker, store=True)
    plain = distributions.box_stats(df, "x", ["g"], whisker)
    assert stored.columns == plain.columns
    for a, b in zip(rows(stored), rows(plain), strict=True):
        assert a[0] == b[0]
        np.testing.assert_allclose(a[1:], b[1:], rtol=1e-12)


def test_stored_outliers_equal_the_others(spark, groups, rows):
    df = frame(spark, groups).withColumnRenamed("v", "x")
    assert rows(distributions.box_outliers(df, "x", ["g"], store=True)) == rows(distributions.box_outliers(df, "x", ["g"]))
