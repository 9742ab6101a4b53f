"""Periodic runs of words: recursive splitting at rare words, then a scan for equal words at a lag."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.hashing import chunks
from murmura.llm.text import fresh_name

LEAST = 6
TIMES = 4


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, cut at white space below 128, and bounds: text i has ``bounds[i]:bounds[i + 1]``."""
    pieces = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, bounds = pieces.flatten(), pieces.offsets.to_numpy()
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(filled)])
    return words.filter(pa.array(filled)), upto[bounds - bounds[0]]


def _segments(places: np.ndarray) -> np.ndarray:
    """A number per place, the same for neighbours without a gap."""
    return np.concatenate([[0], np.cumsum(np.diff(places) != 1)])


def split_at_rare(places: np.ndarray, grams: np.ndarray, often: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of segments in which every gram occurs ``often`` and that hold ``length`` places.

    A gram that its segment holds too seldom splits it, and the parts are
    counted anew, until nothing changes. Only segments that were split are
    looked at again.
    """
    stable = []
    size = int(grams.max()) + 1 if len(grams) else 1
    while len(places):
        segment = _segments(places)
        _, which, counts = np.unique(segment * size + grams, return_inverse=True, return_counts=True)
        keep = (counts[which] >= often) & (np.bincount(segment)[segment] >= length)
        touched = np.bincount(segment, ~keep) > 0
        whole = ~touched[segment]
        stable.append((places[whole], grams[whole]))
        again = keep & ~whole
        places, grams = places[again], grams[again]
    if not stable:
        return places, grams
    places, grams = (np.concatenate(column) for column in zip(*stable))
    order = np.argsort(places)
    return places[order], grams[order]


def _next(places: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """How far ahead in its segment each place's gram occurs again, or 0."""
    segment = _segments(places)
    order = np.lexsort((places, grams, segment))
    same = (grams[order][1:] == grams[order][:-1]) & (segment[order][1:] == segment[order][:-1])
    ahead = np.zeros(len(places), np.int64)
    ahead[order[:-1]] = np.where(same, np.diff(places[order]), 0)
    return ahead


def runs_of(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs in texts of words given as numbers: text, start, length and period, in this order.

    Periods are taken in classes, those above width / 2 up to ``width`` for
    each power of two. A run of such a period q has at least 4 q words, so
    every gram of ``width`` words occurs in it several times, at distances of
    exactly q, since a gram of at least q words tells its place in the period.
    So for each class

    1. segments are split at grams that are too rare in them, until stable;
    2. the surviving segments are scanned for stretches of places whose gram
       comes again at one lag of the class: each is a run less its last words;
    3. grams are doubled for the next class, within the surviving segments.

    Grams are numbered by pairs of numbers, not hashed, so the result is exact.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = np.arange(len(words)) + text  # a gap between texts
    grams = words.astype(np.int64)
    width, found = 1, []
    while len(places):
        low = width // 2 + 1
        often = TIMES if width == 1 else (max(LEAST, TIMES * low) - width + 1) // low
        places, grams = split_at_rare(places, grams, often, max(LEAST, TIMES * low) - width + 1)
        if not len(places):
            break
        lag = _next(places, grams)
        edge = np.flatnonzero(np.concatenate([[True], (lag[1:] != lag[:-1]) | (np.diff(places) != 1), [True]]))
        first, count = edge[:-1], np.diff(edge)
        period, start = lag[first], places[first]
        length = count + width + period - 1
        good = (period >= low) & (period <= width) & (length >= np.maximum(LEAST, TIMES * period))
        found.append(np.stack([start[good], length[good], period[good]]))
        # The gram of twice the width is the pair of this place's and the one a width later.
        other = np.searchsorted(places, places + width)
        segment = _segments(places)
        inside = other < len(places)
        inside[inside] = (places[other[inside]] == places[inside] + width) & (segment[other[inside]] == segment[inside])
        size = int(grams.max()) + 1
        pairs = grams[inside] * size + grams[other[inside]]
        places, grams = places[inside], np.unique(pairs, return_inverse=True)[1]
        width *= 2
    starts, lengths, periods = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((periods, starts))
    starts, lengths, periods = starts[order], lengths[order], periods[order]
    owners = np.searchsorted(bounds[1:] + np.arange(len(bounds) - 1), starts, "right")
    return owners, starts - owners - bounds[owners], lengths, periods


def _kept(bounds: np.ndarray, owners, starts, lengths, periods) -> np.ndarray:
    """Which words stay when of each run only the first period stays."""
    begin = bounds[owners] + starts
    steps = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(steps, begin + periods, 1)
    np.add.at(steps, begin + lengths, -1)
    return np.cumsum(steps[:-1]) == 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _scanned(part: pa.RecordBatch) -> list[pa.Array]:
    """The runs of each text, and the text without what they repeat."""
    words, bounds = split_words(part.column("text"))
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    owners, starts, lengths, periods = runs_of(numbers, bounds)
    columns = [pa.array(column, pa.int64()) for column in (starts, lengths, periods)]
    upto = np.searchsorted(owners, np.arange(len(bounds)))
    runs = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
    keep = _kept(bounds, owners, starts, lengths, periods)
    left = np.concatenate([[0], np.cumsum(keep)])[bounds]
    kept = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep)))
    return [runs, pc.binary_join(kept, pa.scalar(" ", words.type)).cast(pa.string())]


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = batch.schema.names[:-1]
        for part in chunks(batch, "text"):
            columns = [part.column(name) for name in others] + _scanned(part)
            yield pa.RecordBatch.from_arrays(columns, [*others, "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """All periodic runs of each text, one row per row of ``docs``: the id, runs, collapsed.

    A run (start, length, period, counted in words from 0) is a stretch of
    consecutive words in which words a period apart are the same, of at least
    six words and four periods, with no smaller period, that no neighbouring
    word extends. ``runs`` holds all of a text by start and period.
    ``collapsed`` are the words, joined by blanks, without those that any run
    holds after its first period.

    Words are whatever stands between white space, upper and lower case
    apart. Null and empty texts and texts of white space have no runs and
    collapse to an empty text. Equal texts have equal runs; other columns are
    ignored. A text is worked on in one task, in time that grows with its
    words times a power of their logarithm once its segments are stable.
    """
    slim = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = dict(slim.dtypes)["id"]
    ddl = f"id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return slim.mapInArrow(_tasks, ddl).withColumnRenamed("id", id)


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with collapsed texts; a text without runs stays as it is, white space included.

    All columns stay, and a null text stays null.
    """
    whole = fresh_name(docs, "_row")
    packed = docs.select(F.struct(*docs.columns).alias(whole), F.col(text).alias("text"))
    found = periodic_runs(packed, "text", whole)
    row = F.col(whole)
    changed = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(row[text])
    return found.select(*[(changed if c == text else row[c]).alias(c) for c in docs.columns])
