import numpy as np
import pytest

from murmura.operators import distributions as d


def frame(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, x double").repartition(7)


@pytest.fixture
def groups():
    rng = np.random.default_rng(5)
    return {
        "hot": np.concatenate([rng.pareto(0.5, 3000), np.full(2000, 0.25)]),
        "ties": rng.integers(-1, 2, 400) / 2,
        "two": [1.0, 4.0],
        "one": [3.5],
        "flat": [2.0] * 9,
    }


@pytest.mark.parametrize("lots, per_range", [(2, 10), (8, 100), (64, 1), (1024, 50), (1024, 10**6)])
def test_quantiles_are_exact(spark, groups, lots, per_range):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = frame(spark, groups)
    got = d.exact_quantiles(df, "x", ["g"], probs, lots, per_range).collect()
    assert {r["g"] for r in got} == set(groups)
    for r in got:
        np.testing.assert_allclose(r["q"], np.quantile(groups[r["g"]], probs), rtol=1e-12)
        assert r["total"] == len(groups[r["g"]])


def test_cuts_depend_on_the_values_alone(spark, groups):
    """Whatever a lost and repeated task reads first, the query keeps its cuts."""
    rows = [("hot", float(v)) for v in np.random.default_rng(1).normal(size=20000)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = []
    for order in (df.repartition(3), df.orderBy("x").repartition(11, "x"), df.coalesce(1)):
        values = d._values(order, "x", ["g"])
        found.append(d._cuts(values, ["g"], 64, 1250).first()["cuts"])
    assert found[0] == found[1] == found[2] and len(found[0]) == 15
    shares = np.diff(np.searchsorted(np.sort([v for _, v in rows]), found[0]))
    assert shares.max() < 20000 * 0.4
    got = d.exact_quantiles(df, "x", ["g"], [0.5], 64, 1250).first()["q"]
    np.testing.assert_allclose(got, [np.median([v for _, v in rows])])


def test_quantiles_skip_missing_values_and_groups(spark):
    nan = float("nan")
    rows = [("a", 1.0), ("a", None), ("a", nan), ("a", 3.0), (None, 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = d.exact_quantiles(df, "x", ["g"], [0.5]).collect()
    assert [(r["g"], r["total"], r["q"]) for r in got] == [("a", 2, [2.0])]


def test_tukey_boxes(spark, groups):
    df = frame(spark, groups)
    outliers = d.box_outliers(df, "x", ["g"])
    for r in d.box_stats(df, "x", ["g"], whisker="tukey").collect():
        v = np.asarray(groups[r["g"]])
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        want = [min(inside.min(), q1), q1, q2, q3, max(inside.max(), q3)]
        got = [r[c] for c in ("whisker_low", "q1", "median", "q3", "whisker_high")]
        np.testing.assert_allclose(got, want, rtol=1e-12)
        assert r["n"] == len(v) and r["n_outliers"] == len(v) - len(inside)
        listed = outliers.filter(outliers.g == r["g"]).selectExpr("sum(n)").first()[0]
        assert (listed or 0) == r["n_outliers"]


def test_minmax_boxes(spark, groups):
    for r in d.box_stats(frame(spark, groups), "x", ["g"]).collect():
        want = np.quantile(groups[r["g"]], [0, 0.25, 0.5, 0.75, 1])
        got = [r[c] for c in ("whisker_low", "q1", "median", "q3", "whisker_high")]
        np.testing.assert_allclose(got, want, rtol=1e-12)


def test_unknown_whisker(spark):
    with pytest.raises(ValueError):
        d.box_stats(spark.createDataFrame([("a", 1.0)], "g string, x double"), "x", ["g"], "iqr")


def test_histograms_match_numpy(spark, groups):
    df = frame(spark, groups)
    everything = np.concatenate([np.asarray(v, dtype=float) for v in groups.values()])
    whole = d.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram(everything, 20)
    assert [r["n"] for r in whole] == counts.tolist()
    np.testing.assert_allclose([r["bin_low"] for r in whole], edges[:-1])
    np.testing.assert_allclose([r["bin_high"] for r in whole], edges[1:])
    got = d.histogram(df, "x", by=["g"]).orderBy("g", "bin").collect()
    for g, values in groups.items():
        mine = [r for r in got if r["g"] == g]
        counts, edges = np.histogram(values, 20)
        assert [r["n"] for r in mine] == counts.tolist()
        np.testing.assert_allclose([r["bin_low"] for r in mine], edges[:-1])


def test_histogram_skips_missing_values(spark):
    rows = [("a", 0.0), ("a", 1.0), ("a", None), ("a", float("nan")), (None, 9.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    grouped = {r["bin"]: r["n"] for r in d.histogram(df, "x", 4, ["g"]).collect()}
    assert grouped == {0: 1, 1: 0, 2: 0, 3: 1}
    assert [r["n"] for r in d.histogram(df, "x", 3).orderBy("bin").collect()] == [2, 0, 1]


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, x double")
    assert sum(r["n"] for r in d.histogram(empty, "x").collect()) == 0
    assert d.histogram(empty, "x", by=["g"]).collect() == []


def test_binned_scatter(spark):
    rows = [("a", 0.0, 0.0), ("a", 1.0, 10.0), ("a", 0.96, 9.6), ("b", 0.5, 5.0), ("b", None, 99.0)]
    rows += [(None, 0.1, 1.0), ("b", float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "subreddit string, sentiment double, score double")
    got = {(r["subreddit"], r["x_bin"], r["y_bin"]): r["n"] for r in d.binned_scatter(df).collect()}
    assert got == {("a", 0, 0): 1, ("a", 19, 19): 2, ("b", 10, 10): 1}


def test_only_wanted_ranges_are_shuffled(spark):
    """20,000 values of a hot group: the quartiles need a few ranges, not all rows."""
    rows = [("hot", float(v)) for v in np.random.default_rng(2).normal(size=20000)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    df.write.mode("overwrite").parquet(path := spark.conf.get("spark.checkpoint.dir") + "/values")
    stored = spark.read.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    group = "shuffled-records"
    spark.sparkContext.setJobGroup(group, group)
    got = d.box_stats(stored, "x", ["g"], lots=256, per_range=100).collect()
    spark.sparkContext.setJobGroup("", "")
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    written = [store.lastStageAttempt(s).shuffleWriteRecords() for s in stages]
    assert max(written) < 5000
    np.testing.assert_allclose(got[0]["median"], np.median([v for _, v in rows]))


def test_too_many_groups_for_a_broadcast_are_an_error(spark):
    from pyspark.errors import PySparkException

    from murmura.operators.skew import small

    df = spark.range(11)
    assert df.join(small(df, 11), "id").count() == 11
    with pytest.raises(PySparkException, match="more than 10 rows"):
        df.join(small(df, 10), "id").count()
