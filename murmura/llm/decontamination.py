"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm.hashing import LETTERS_DIGITS, Words, chunks, grams, split_words
from murmura.llm.text import join_same, without
from murmura.sources.scratch import stage

WINDOW = 13
GRAM = 5
FILTER_BITS = 1 << 24

_MARK = pa.schema(
    [
        ("id", pa.int64()),
        ("version", pa.int64()),
        ("n_words", pa.int64()),
        ("kind", pa.int32()),
        ("gram", pa.int64()),
        ("at", pa.int64()),
        ("before", pa.list_(pa.int64())),
        ("after", pa.list_(pa.int64())),
    ]
)
_MARK_DDL = (
    "id long, version long, n_words long, kind int, gram long, at long, "
    "before array<long>, after array<long>"
)
HEADER, WINNOWED = -1, 0


def winnowed(words: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the grams kept, and the hash of the gram at every place.

    Of every ``window - gram + 1`` grams in a row the least is kept, of equal
    ones the last, so whoever shares ``window`` words shares a kept gram.
    """
    hashes = grams(words.hashes, gram)
    row = window - gram + 1
    n = len(words.hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), hashes
    ends = np.repeat(words.bounds[1:], words.counts())[:n]
    inside = np.flatnonzero(np.arange(n) + window <= ends)
    rows = np.lib.stride_tricks.sliding_window_view(hashes, row)
    least = np.empty(n, np.int64)
    for begin in range(0, n, 1 << 16):
        part = rows[begin : min(n, begin + (1 << 16)), ::-1]
        least[begin : begin + len(part)] = row - 1 - part.argmin(axis=1)
    kept = np.zeros(len(hashes), bool)
    kept[inside + least[inside]] = True
    return np.flatnonzero(kept), hashes


def _marks(words: Words, kind: int, places, hashes, reach: int, ids, versions) -> pa.RecordBatch:
    """A row per kept gram, with the words around it as far as a window can reach."""
    owner = np.searchsorted(words.bounds, places, "right") - 1
    low, high = words.bounds[owner], words.bounds[owner + 1]
    size = kind or GRAM
    before = [words.hashes[max(a, p - reach) : p][::-1] for a, p in zip(low, places)]
    after = [words.hashes[p + size : min(b, p + size + reach)] for b, p in zip(high, places)]

    def lists(parts):
        offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))

    take = pa.array(owner)
    return pa.RecordBatch.from_arrays(
        [
            ids.take(take),
            versions.take(take),
            pa.array(words.counts()[owner].astype(np.int64)),
            pa.array(np.full(len(places), kind, np.int32)),
            pa.array(hashes[places].view(np.int64)),
            pa.array((places - low).astype(np.int64)),
            lists(before),
            lists(after),
        ],
        schema=_MARK,
    )


def _headers(words: Words, ids, versions) -> pa.RecordBatch:
    n = len(words)
    empty = pa.array([[]] * n, pa.list_(pa.int64()))
    zero = pa.array(np.zeros(n, np.int64))
    kind = pa.array(np.full(n, HEADER, np.int32))
    counts = pa.array(words.counts().astype(np.int64))
    return pa.RecordBatch.from_arrays([ids, versions, counts, kind, zero, zero, empty, empty], schema=_MARK)


def _places(words: Words, size: int) -> np.ndarray:
    """Where ``size`` words of one text follow."""
    ends = np.repeat(words.bounds[1:], words.counts())
    return np.flatnonzero(np.arange(len(words.hashes)) + size <= ends)


def _items():
    """Benchmark items as marks: kept grams, or the whole item if it is shorter than a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, versions = part.column("id"), part.column("version")
                words = split_words(part.column("text"), LETTERS_DIGITS)
                places, hashes = winnowed(words, GRAM, WINDOW)
                yield _marks(words, WINNOWED, places, hashes, WINDOW - GRAM, ids, versions)
                counts = words.counts()
                for size in np.unique(counts[(counts > 0) & (counts < WINDOW)]):
                    places = words.bounds[:-1][counts == size]
                    hashes = grams(words.hashes, int(size))
                    yield _marks(words, int(size), places, hashes, 0, ids, versions)

    return run


def _documents(filter_bits: np.ndarray, short: list[int]):
    """Documents as headers, and marks that the filter of the benchmark lets through."""

    def known(hashes: np.ndarray) -> np.ndarray:
        bit = hashes & np.uint64(FILTER_BITS - 1)
        return (filter_bits[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, versions = part.column("id"), part.column("version")
                words = split_words(part.column("text"), LETTERS_DIGITS)
                yield _headers(words, ids, versions)
                places, hashes = winnowed(words, GRAM, WINDOW)
                places = places[known(hashes[places])]
                if len(places):
                    yield _marks(words, WINNOWED, places, hashes, WINDOW - GRAM, ids, versions)
                for size in short:
                    hashes, places = grams(words.hashes, size), _places(words, size)
                    places = places[known(hashes[places])]
                    if len(places):
                        yield _marks(words, size, places, hashes, 0, ids, versions)

    return run


def _filter(items: DataFrame) -> np.ndarray:
    """A bit per hash value modulo 2**24: two megabytes, however large the benchmark is."""
    bit = F.col("gram").bitwiseAND(F.lit(FILTER_BITS - 1))
    word = items.select(
        F.shiftright(bit, 6).alias("word"),
        F.expr(f"shiftleft(1L, cast(gram & {FILTER_BITS - 1} & 63 as int))").alias("bits"),
    )
    rows = word.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    if rows:
        at, bits = zip(*rows)
        out[np.array(at)] = np.array(bits, np.int64).view(np.uint64)
    return out


def _agreeing(left: str, right: str) -> Column:
    """How many values two arrays have in common from the first on."""
    equal = F.zip_with(left, right, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(equal, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(equal).cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words of each document inside benchmark passages, one row per row of ``docs``.

    Result: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A
    window is 13 consecutive words of an item, or a whole item of fewer. Both
    sides are winnowed to the least 5-gram hash of every nine, so every shared
    window shares a mark; marks are joined and extended word by word as far as
    a window can reach, and runs of 13 or more words are hits. Items shorter
    than a window are looked up by their own length.

    Only marks that pass a filter of fixed size, made of the benchmark's
    marks, leave the scan of the documents; all of them are then joined, so
    the filter loses nothing. The benchmark is broadcast only if Spark finds
    its written table below the broadcast threshold. Words are compared by
    64-bit hashes.

    Null texts and texts without words have no hits; a null item has no
    window; items without id are named by an empty string. Equal rows get
    equal results; other columns are ignored; empty tables are allowed.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("version"), "text"
    )
    items = stage(items.mapInArrow(_items(), _MARK_DDL), "benchmark_marks")
    short = [row[0] for row in items.select("kind").filter("kind > 0").distinct().collect()]
    bits = spark.sparkContext.broadcast(_filter(items))
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"), "text")

    def scan(batches):
        yield from _documents(bits.value, short)(batches)

    marks = stage(texts.mapInArrow(scan, _MARK_DDL), "document_marks")
    size = F.when(F.col("kind") == WINNOWED, GRAM).otherwise(F.col("kind"))
    theirs = items.select(
        "kind",
        "gram",
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("item"),
        F.col("before").alias("item_before"),
        F.col("after").alias("item_after"),
    ).distinct()
    met = marks.filter("kind >= 0").join(theirs, ["kind", "gram"]).select(
        "id",
        "version",
        "item",
        "kind",
        (F.col("at") - _agreeing("before", "item_before")).alias("start"),
        (F.col("at") + size + _agreeing("after", "item_after")).alias("end"),
    )
    hits = met.filter((F.col("kind") > 0) | (F.col("end") - F.col("start") >= WINDOW)).drop("kind").distinct()
    key = ["id", "version"]
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    spans = hits.select(*key, "start", "end").distinct().withColumn("reached", reached)
    covered = spans.groupBy(key).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("reached"))).alias("n_hit"))
    found = hits.groupBy(key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    heads = marks.filter(F.col("kind") == HEADER).select(*key, "n_words")
    joined = join_same(join_same(heads, covered, key, "left"), found, key, "left")
    joined = joined.withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
            "items": F.coalesce("items", F.array().cast("array<string>")),
        }
    )
    return joined.select(
        F.col("id").alias("doc_id"),
        "version",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the contaminated ones."""
    return without(docs, contamination(docs, benchmark).filter("contaminated"))
