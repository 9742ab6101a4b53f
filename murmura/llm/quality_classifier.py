"""Quality classifier with hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.hashing import NOT_SPACE, chunks, split_words
from murmura.llm.sampling import bounded_sample
from murmura.llm.text import join_same, without
from murmura.sources.scratch import stage

MAX_LABELLED = 20_000
FEATURES = (
    "log_words",
    "word_bytes",
    "capitals",
    "digits",
    "symbols",
    "exclamations",
    "bars",
    "other_marks",
    "line_feeds",
    "same_as_before",
    "distinct",
)

_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "symbols": b"#*$%&<>@\\^_~=+{}[]",
    "exclamations": b"!?",
    "bars": b"|",
    "other_marks": b".,;:()'\"-/",
    "line_feeds": b"\n",
}


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.uint8)
    for number, chars in enumerate(_CLASSES.values()):
        table[list(chars)] = number
    return table


_TABLE = _class_table()


def style_features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` per text; shares of bytes or words, all between 0 and about 10."""
    words = split_words(texts, NOT_SPACE)
    n, counts = len(words), words.counts()
    out = np.zeros((n, len(FEATURES)), np.float64)
    lengths = np.zeros(n, np.int64)
    owner = words.text_of_word()
    np.add.at(lengths, owner, words.ends - words.starts)
    safe = np.maximum(counts, 1)
    out[:, 0] = np.log1p(counts)
    out[:, 1] = np.minimum(lengths / safe, 100) / 10
    offsets = _offsets(texts)
    kinds = _TABLE[words.data]
    for number in range(len(_CLASSES)):
        upto = np.concatenate([[0], np.cumsum(kinds == number)])
        share = (upto[offsets[1:]] - upto[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)
        out[:, 2 + number] = share * 10
    again = np.zeros(len(owner) + 1, np.int64)
    again[2:] = np.cumsum((words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1]))
    low, high = words.bounds[:-1], words.bounds[1:]
    out[:, 9] = np.where(counts > 0, again[high] - again[np.minimum(low + 1, high)], 0) / safe
    for i in range(n):
        out[i, 10] = len(np.unique(words.hashes[low[i] : high[i]])) / safe[i]
    return out


def _offsets(texts: pa.Array) -> np.ndarray:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("host", pa.string()),
        ("path", pa.string()),
        ("version", pa.int64()),
        ("features", pa.list_(pa.float64())),
    ]
)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            table = style_features(part.column("text"))
            offsets = pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(table.reshape(-1)))
            columns = [part.column(c) for c in ("doc_id", "host", "path", "version")]
            yield pa.RecordBatch.from_arrays([*columns, lists], schema=_SCHEMA)


def fitted(features: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[list[float], float]:
    """Weights and intercept of a logistic regression on at most ``max_labelled`` labelled rows.

    The rows are those with the least hash of the id, so reruns agree. With
    no label, or one class only, the weights are zero and the evidence is the
    smoothed share of good labels. Of several labels of an id the greatest
    holds.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").select("doc_id", "label")
    known = known.groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    rows = features.join(known, "doc_id").select("doc_id", "version", "label", "features")
    sample = bounded_sample(rows, max_labelled, F.xxhash64("doc_id"), "doc_id", "version")
    sample = stage(sample.select("label", "features"), "labelled")
    n, good = sample.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if good in (0, n):
        share = (good + 1) / (n + 2)
        return [0.0] * len(FEATURES), float(np.log(share / (1 - share)))
    model = LogisticRegression(maxIter=50, regParam=1e-3).fit(
        sample.select("label", array_to_vector("features").alias("features"))
    )
    return [float(w) for w in model.coefficients], float(model.intercept)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _bounded(p: Column) -> Column:
    return F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))


def _strength(groups: DataFrame, prior: str) -> float:
    """How many documents a group's prior is worth, by the method of moments.

    The spread of group means about their prior beyond what sampling explains
    is the true spread; the smaller it is, the more a prior is worth: one
    document at least and a thousand at most, also where there is no spread.
    """
    mean = F.col("total") / F.col("n")
    noise = F.col(prior) * (1 - F.col(prior)) / F.col("n")
    spread, scale = groups.agg(
        F.sum(F.col("n") * ((mean - F.col(prior)) ** 2 - noise)) / F.sum("n"),
        F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior))) / F.sum("n"),
    ).first()
    if spread is None or spread <= 0:
        return 1000.0
    return float(min(1000.0, max(1.0, scale / spread - 1)))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    at_least: float = 0.5,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Quality of each document, one row per row of ``docs``.

    Result: doc_id, version (hash of the text), evidence, host_quality,
    path_quality, quality, kept.

    1. Evidence: the probability of good quality by a logistic regression on
       style features of the whole text, fitted on a bounded sample of
       ``labels`` (doc_id, label 0 or 1).
    2. A host's quality is the mean evidence of its documents, shrunk towards
       the global mean; a path's within the host is shrunk towards the host.
       What a prior is worth is estimated from the spread between groups, so
       sparse sites follow their prior. A document's own evidence is left out
       of both.
    3. Posterior odds = odds of the evidence * odds of the path / odds of the
       global mean; ``kept`` if the probability reaches ``at_least``.

    Null and empty texts have no words and get the evidence of such texts;
    missing hosts and paths are groups of their own; equal rows get equal
    results. Groups are summed up in each task before the shuffle, so a hot
    host is no hot key. Labels of unknown documents are ignored.
    """
    slim = docs.select(
        "doc_id",
        F.col(host).cast("string").alias("host"),
        F.col(path).cast("string").alias("path"),
        F.xxhash64("text").alias("version"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ddl = "doc_id long, host string, path string, version long, features array<double>"
    features = stage(slim.mapInArrow(_features, ddl), "features")
    weights, intercept = fitted(features, labels, max_labelled)
    score = F.lit(intercept)
    for place, weight in enumerate(weights):
        score = score + F.lit(weight) * F.get("features", F.lit(place))
    evidence = _bounded(1 / (1 + F.exp(-score)))
    known = features.select("doc_id", "host", "path", "version", evidence.alias("evidence"))

    paths = known.groupBy("host", "path").agg(F.sum("evidence").alias("total"), F.count(F.lit(1)).alias("n"))
    paths = stage(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    total, n = paths.agg(F.sum("total"), F.sum("n")).first()
    mean = min(1 - 1e-6, max(1e-6, total / n)) if n else 0.5
    of_host = _strength(hosts.withColumn("prior", F.lit(mean)), "prior")
    shrunk = (F.col("total") + of_host * mean) / (F.col("n") + of_host)
    hosts = stage(hosts.withColumn("prior", shrunk), "hosts")
    of_path = _strength(join_same(paths, hosts.select("host", "prior"), ["host"]), "prior")

    sums = hosts.select("host", F.col("total").alias("host_total"), F.col("n").alias("host_n"))
    joined = join_same(join_same(known, paths, ["host", "path"]), sums, ["host"])
    own = F.col("evidence")
    host_quality = (F.col("host_total") - own + of_host * mean) / (F.col("host_n") - 1 + of_host)
    path_quality = (F.col("total") - own + of_path * F.col("host_quality")) / (F.col("n") - 1 + of_path)
    joined = joined.withColumn("host_quality", _bounded(host_quality))
    joined = joined.withColumn("path_quality", _bounded(path_quality))
    odds = _logit(own) + _logit(F.col("path_quality")) - F.lit(float(np.log(mean / (1 - mean))))
    joined = joined.withColumn("quality", 1 / (1 + F.exp(-odds)))
    columns = ["doc_id", "version", "evidence", "host_quality", "path_quality", "quality"]
    return joined.select(*columns, (F.col("quality") >= at_least).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    return without(docs, quality(docs, labels, **settings).filter("NOT kept"))
