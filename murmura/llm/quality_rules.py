"""Quality rules: lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.text import SPACE, join_same, whole, word_count, words
from murmura.sources.scratch import stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MAX_DOCS = 20
MIN_LEFT_PERCENT = 30


def _windows() -> Column:
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("words"), i, WINDOW)))
    return F.when(F.size("words") >= WINDOW, hashes).otherwise(F.array().cast("array<long>"))


def _repeated_starts() -> Column:
    """Starts of the windows that occur more than once, in order; only built where there are any."""
    places = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return F.when(repeats, places)


def _covered() -> Column:
    places = F.col("places")

    def twice(place: Column, i: Column) -> Column:
        before = F.get(places, i - 1)["h"]
        after = F.get(places, i + 1)["h"]
        return F.coalesce(place["h"] == before, F.lit(False)) | F.coalesce(place["h"] == after, F.lit(False))

    starts = F.array_sort(F.transform(F.filter(places, twice), lambda place: place["i"]))
    first = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-WINDOW).alias("last"))
    total = F.aggregate(
        starts,
        first,
        lambda acc, i: F.struct(
            (acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total"), i.alias("last")
        ),
        lambda acc: acc["total"],
    )
    return F.coalesce(total, F.lit(0).cast("long"))


def _line(line: Column) -> Column:
    """A line's normalised form as a hash, and its words.

    Lower case, with digits and white space as single blanks.
    """
    normal = F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D0-9]+", " "))
    return F.struct(F.xxhash64(normal).alias("line"), word_count(line).alias("n"))


def document_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures of each document by itself, and its lines as hashes.

    Columns: doc_id, host, text_hash, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, lines. Windows of words are
    compared by 64-bit hashes within one document.
    """
    text = F.col("text")
    parsed = docs.select("doc_id", F.col(host).alias("host"), whole("text").alias("text")).withColumns(
        {
            "words": words(text),
            "rows": F.filter(F.split(text, "\n", -1), lambda row: row.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    parsed = parsed.withColumn("windows", _windows()).withColumn("places", _repeated_starts())
    figures = parsed.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("rows") - F.size(F.array_distinct("rows"))).cast("long").alias("n_dup_lines"),
        _covered().alias("n_repeat_words"),
        F.transform("rows", _line).alias("lines"),
    )
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return figures.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeated)


def frequent_lines(figures: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Lines that more than ``max_docs`` different documents of a host hold.

    Exact copies of a document count once, or a page that was crawled often
    would make all its own lines frequent. Both counts are summed up in each
    task before they are shuffled, so a very common line is no hot key.
    """
    held = figures.select("host", "text_hash", F.explode(F.array_distinct("lines.line")).alias("line"))
    once = held.groupBy("host", "line", "text_hash").agg(F.lit(1).alias("one"))
    counts = once.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.filter(F.col("n_docs") > max_docs)


def line_frequency(
    docs: DataFrame,
    host: str = "source",
    max_docs: int = MAX_DOCS,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """Quality verdict of each document, one row per row of ``docs``.

    Result: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_removed (words in frequent lines), kept.
    A document goes when it fails a rule by itself, or when the lines that
    stay after removing the frequent ones of its host hold less than
    ``min_left_percent`` of its words.

    A null text is empty and fails. A missing host is a host of its own.
    Equal rows get equal results; other columns of ``docs`` are ignored.
    """
    figures = stage(document_rules(docs, host), "line_figures")
    frequent = stage(frequent_lines(figures, max_docs), "frequent_lines")
    held = figures.select("doc_id", "host", "text_hash", F.explode("lines").alias("held")).select(
        "doc_id", "host", "text_hash", F.col("held.line").alias("line"), F.col("held.n").alias("n")
    )
    key = ["doc_id", "host", "text_hash"]
    marked = join_same(held, frequent, ["host", "line"], "left_semi")
    removed = marked.groupBy(key).agg(F.sum("n").alias("words"))
    # A repeated row has added its words as often as it occurs.
    repeated = figures.groupBy(key).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    removed = join_same(removed, repeated, key, "left").select(
        *key, (F.col("words") / F.coalesce("times", F.lit(1))).cast("long").alias("n_removed")
    )
    joined = join_same(figures, removed, key, "left")
    gone = F.coalesce("n_removed", F.lit(0).cast("long"))
    enough = 100 * (F.col("n_words") - gone) >= min_left_percent * F.col("n_words")
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        gone.alias("n_removed"),
        (~F.col("base_failed") & enough).alias("kept"),
    )
