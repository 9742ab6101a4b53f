import io
from datetime import date, datetime

import pandas as pd
from pyspark.sql import functions as F

from murmura import functions as f
from murmura.functions.text import WHITESPACE

BLANKS = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def one(spark, column, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


def test_whitespace_is_pythons():
    assert sorted(WHITESPACE) == sorted(BLANKS)


def test_clean_text_strips_like_python(spark):
    texts = [b + "A b" + b for b in BLANKS] + ["", " ", " Où　", "a​", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    found = [r[0] for r in df.select(f.clean_text(F.col("x"))).collect()]
    assert found == [(t or "").lower().strip() for t in texts]


def test_tokens_are_unicode_words(spark):
    def words(text, n=1):
        return one(spark, lambda c: f.tokens(c, n), text)

    assert words("Où é_a b-c 3x naïve") == ["où", "é_a", "b", "c", "3x", "naïve"]
    assert words("éa") == ["e", "a"]
    assert words("a‿b 中文") == ["a", "b", "中文"]
    assert words("one three four5 \U0001d4d0\U0001d4d0\U0001d4d0 abc", 4) == ["three", "four5"]
    assert words("") == []


def test_stopwords():
    assert len(f.STOPWORDS) == 176
    assert {"yourselves", "où", "cette", "removed"} <= f.STOPWORDS


def test_post_text_skips_missing_parts(spark):
    df = spark.createDataFrame([("t", "b"), (None, "b"), ("t", None)], "t string, b string")
    assert [r[0] for r in df.select(f.post_text(F.col("t"), F.col("b"))).collect()] == [
        "t b",
        "b",
        "t",
    ]


def test_latin1_matches_python(spark):
    text = "café € \U0001f600 — x"
    want = text.encode("latin-1", "replace").decode("latin-1")
    assert one(spark, f.latin1_fold, text) == want
    assert one(spark, f.latin1_fold, 7, "int") == "7"


def test_report_title(spark):
    assert one(spark, f.report_title, "x" * 75) == "x" * 75
    assert one(spark, f.report_title, "—" * 76) == "?" * 75 + "..."
    assert one(spark, f.report_title, "\U0001f600" * 76) == "?" * 75 + "..."


def test_csv_line_matches_pandas(spark):
    rows = [
        ("plain", 1.5, 3),
        ('say "hi", ok', -0.0, None),
        ("two\nlines", None, 0),
        ("cr\rhere", 2.0, 1),
        ("", 1.0, 2),
        (" padded ", 1.0, 2),
        (None, 1.0, 2),
    ]
    df = spark.createDataFrame(rows, "a string, b double, c int")
    found = [r[0] for r in df.select(f.csv_line(F.col("a"), F.col("b"), F.col("c"))).collect()]
    for row, line in zip(rows, found):
        frame = pd.DataFrame([row], columns=["a", "b", "c"]).astype({"c": "Int64"})
        assert line == frame.to_csv(index=False, header=False).removesuffix("\n")
        back = pd.read_csv(io.StringIO(line + "\n"), header=None)
        assert len(back) == 1


def test_lenient_casts(spark):
    texts = ["1", "2.0", "abc", "", None, "nan", "inf", "1e2", "99999999999", " 7 "]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    x = F.col("x")
    got = df.select(f.to_double(x), f.to_int(x), f.to_int(x, "lenient")).collect()
    assert [r[0] for r in got] == [
        1.0, 2.0, None, None, None, None, float("inf"), 100.0, 99999999999.0, 7.0,
    ]
    assert [r[1] for r in got] == [1, None, None, None, None, None, None, None, None, 7]
    assert [r[2] for r in got] == [1, 2, None, None, None, None, None, 100, None, 7]


def test_keyword_sentiment(spark):
    for text, score in [
        ("goodbye", 0.5),
        ("bad day", -0.5),
        ("good and bad", 0.5),
        ("ok", 0.0),
        ("", 0.0),
    ]:
        assert one(spark, f.keyword_sentiment, text) == score


def test_sign_predicates_hold_nan_and_null_for_none(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (float("nan"),), (None,)], "x double")
    x = f.nan_to_null(F.col("x"))
    got = [
        tuple(r) for r in df.select(f.is_positive(x), f.is_negative(x), f.is_neutral(x)).collect()
    ]
    assert got[:3] == [(True, False, False), (False, True, False), (False, False, True)]
    assert got[3:] == [(False, False, False)] * 2


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("1700000000.0",), ("bad",), (None,)], "created_utc string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = f.with_dates(df).collect()
        instants = df.select(F.timestamp_seconds(F.col("created_utc").try_cast("double")).alias("t"))
        hours = instants.select(f.utc(instants, "t").alias("t")).select(f.hour_bucket(F.col("t")))
        assert hours.collect()[0][0] == datetime(2023, 11, 14, 22)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got[0]["date"] == datetime(2023, 11, 14, 22, 13, 20)
    assert got[0]["hour"] == 22 and got[0]["day"] == date(2023, 11, 14)
    assert got[1]["date"] is None and got[2]["day"] is None


def test_frames_without_a_time_stay_as_they_are(spark):
    df = spark.range(1)
    assert f.with_dates(df).columns == ["id"]
