"""Toxicity: logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.hashing import LETTERS_DIGITS, chunks, grams, mix, split_words
from murmura.llm.sampling import bounded_sample
from murmura.llm.text import whole
from murmura.sources.scratch import stage

MAX_LABELLED = 20_000
MAX_WORDS = 5_000_000
MAX_WEIGHTS = 100_000
SKIPS = (1, 2)
_BUCKETS = 25


@dataclass(frozen=True)
class Rates:
    """Settings of FTRL-proximal.

    A coordinate's rate is ``alpha`` over ``beta`` plus the root of its summed
    squared gradients. Weights stay zero until their gradients exceed ``l1``.
    Coordinates of fewer than ``least_docs`` documents are not learnt.
    """

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 10
    least_docs: int = 4


@dataclass(frozen=True)
class Model:
    """Hashes of the coordinates with a weight, in order; their weights; the intercept."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every word, word pair and pair over one or two words as a hash, its text's number, and a value per text.

    Words are runs of letters and digits, A to Z in lower case. A coordinate
    counts once in a text, by the text's value, which falls slowly with the
    number of words; features come as often as they occur, in no order.
    """
    words = split_words(texts, LETTERS_DIGITS)
    h, owner = words.hashes, words.text_of_word()
    hashes, owners = [mix(h + np.uint64(1))], [owner]
    for apart in (1, *(skip + 1 for skip in SKIPS)):
        if len(h) <= apart:
            continue
        same = owner[apart:] == owner[:-apart]
        pair = grams(h, 2) if apart == 1 else mix(h[:-apart] * np.uint64(2 * apart + 1) + mix(h[apart:]))
        hashes.append(pair[same])
        owners.append(owner[apart:][same])
    return np.concatenate(hashes), np.concatenate(owners), 3 / np.log(8 + 4 * words.counts())


def once(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features without repeats in a text, in order of text and hash."""
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    hashes, owners, value = features(texts)
    total = np.zeros(len(texts))
    if len(model.keys) and len(hashes):
        place = np.minimum(np.searchsorted(model.keys, hashes), len(model.keys) - 1)
        hit = model.keys[place] == hashes
        hashes, owners = once(hashes[hit], owners[hit])
        weights = model.weights[np.searchsorted(model.keys, hashes)]
        total = np.bincount(owners, weights, len(texts))
    return _sigmoid(model.intercept + value * total)


def _sparse(z: np.ndarray, n: np.ndarray, r: Rates) -> np.ndarray:
    """The weights that a coordinate's sums stand for."""
    shrunk = z - np.clip(z, -r.l1, r.l1)
    return -shrunk / ((r.beta + np.sqrt(n)) / r.alpha + r.l2)


def follow(docs: list[np.ndarray], values: np.ndarray, labels: np.ndarray, size: int, r: Rates):
    """FTRL-proximal over documents given as coordinates below ``size``: the weights and the intercept."""
    z, n = np.zeros(size), np.zeros(size)
    share = (labels.sum() + 1) / (len(labels) + 2)
    intercept, squares = float(np.log(share / (1 - share))), 0.0
    for _ in range(r.epochs):
        for coordinates, value, label in zip(docs, values, labels):
            zs, ns = z[coordinates], n[coordinates]
            weights = _sparse(zs, ns, r)
            error = float(_sigmoid(intercept + value * weights.sum())) - label
            gradient = error * value
            grown = ns + gradient * gradient
            z[coordinates] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / r.alpha * weights
            n[coordinates] = grown
            squares += error * error
            intercept -= 0.1 * error / (1 + squares**0.5)
    return _sparse(z, n, r), intercept


def _learner(r: Rates, max_words: int, max_weights: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weights of the batches' texts and labels, and the intercept without a hash."""
        counts = np.zeros(1 << _BUCKETS, np.uint16)
        found, values, labels, words = [], [], [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                if words >= max_words:
                    continue
                hashes, owners, value = features(part.column("text"))
                hashes, owners = once(hashes, owners)
                words += int(np.round(np.exp(3 / value) - 8).sum()) // 4
                np.add.at(counts, hashes >> np.uint64(64 - _BUCKETS), 1)
                found.append(np.split(hashes, np.searchsorted(owners, np.arange(1, len(value)))))
                values.append(value)
                labels.append(part.column("label").to_numpy())
        if not labels:
            return
        docs = [
            h[counts[h >> np.uint64(64 - _BUCKETS)] >= r.least_docs] for part in found for h in part
        ]  # counts may be too great, where two coordinates share a bucket, never too small
        found = None
        keys = np.unique(np.concatenate(docs))
        docs = [np.searchsorted(keys, h).astype(np.int32) for h in docs]
        weights, intercept = follow(docs, np.concatenate(values), np.concatenate(labels), len(keys), r)
        best = np.sort(np.argsort(-np.abs(weights), kind="stable")[:max_weights])
        best = best[weights[best] != 0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *keys[best].view(np.int64).tolist()], pa.int64()),
                pa.array([intercept, *weights[best].tolist()], pa.float64()),
            ],
            ["key", "weight"],
        )

    return learn


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    rates: Rates = Rates(),
    max_labelled: int = MAX_LABELLED,
    max_words: int = MAX_WORDS,
    max_weights: int = MAX_WEIGHTS,
) -> Model:
    """A model of the labelled texts.

    At most half of ``max_labelled`` documents of either label are learnt
    from, those with the least hash of their id, and of these about
    ``max_words`` words; so one task can follow them one after another, which
    is how this learner works. The intercept is moved to the share of labels
    among all labelled documents. The ``max_weights`` greatest weights stay.
    With one label only there are no weights, and every score is the smoothed
    share of positive labels.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").select("doc_id", "label")
    known = known.groupBy("doc_id").agg(F.max((F.col("label") > 0).cast("long")).alias("label"))
    ids = docs.select("doc_id").distinct()
    present = stage(known.join(ids, "doc_id", "left_semi"), "labelled")
    n, bad = present.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (bad + 1) / (n + 2)
    prior = float(np.log(share / (1 - share)))
    if bad in (0, n):
        return Model(np.zeros(0, np.uint64), np.zeros(0), prior)
    lot = F.xxhash64("doc_id")
    half = max(1, max_labelled // 2)
    sides = [bounded_sample(present.filter(F.col("label") == side), half, lot, "doc_id") for side in (0, 1)]
    sample = stage(sides[0].union(sides[1]), "sample")
    texts = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    ordered = stage(texts, "sample_texts").coalesce(1).sortWithinPartitions(lot, "doc_id")
    learnt = ordered.select("text", "label").mapInArrow(_learner(rates, max_words, max_weights), "key long, weight double")
    rows = stage(learnt, "weights").orderBy(F.col("key").asc_nulls_first()).toArrow()
    weights = rows["weight"].to_numpy()
    keys = rows["key"][1:].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    few, many = min(half, n - bad), min(half, bad)
    drawn = float(np.log((many + 1) / (few + 1)))
    return Model(keys[order], weights[1:][order], float(weights[0]) + prior - drawn)


def toxicity(docs: DataFrame, labels: DataFrame, at_least: float = 0.7, **settings) -> DataFrame:
    """Toxicity of each document, one row per row of ``docs``: doc_id, score, predicted.

    ``labels`` (doc_id, label) holds 1 for toxic documents and 0 for others.
    Logistic regression over hashed words, word pairs and pairs that skip one
    or two words, each once a text, on the whole text; the weights are sparse
    and go to every task. ``predicted`` is 1 where the score reaches ``at_least``.

    A null or empty text has no words and gets the intercept's score. Labels
    without id, without value or of unknown documents are ignored; of several
    labels of an id the greatest holds, of several texts of an id the greatest
    is learnt from. Equal texts get equal scores, whatever their other columns.
    """
    model = fitted(docs, labels, **settings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores(part.column("text"), model))], ["doc_id", "score"]
                )

    scored = docs.select("doc_id", whole("text").alias("text")).mapInArrow(score, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= at_least).cast("int"))
