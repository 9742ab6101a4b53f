"""How filters interact: counts of which filters a document fails, contracted for every order of the filters."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.text import whole, words
from murmura.sources.scratch import stage

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def conditions(text: Column) -> dict[str, Column]:
    """Which of the filters a text fails by itself."""
    said = words(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(said) < 100,
        "B": 100 * F.size(F.array_distinct(said)) < 80 * F.size(said),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Counts by part and failed filters: part, A to E (0 or 1), n, good, toxic.

    ``E`` fails where a smaller id has the same text, compared by SHA-256. Of
    each text the rows of its least id are looked up by text and id, so a text
    with very many copies is no hot key; repeated rows are added up in each
    task before they are shuffled.
    """
    slim = docs.select(
        F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole("text").alias("text")
    )
    own = slim.select(
        "id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("same"),
        *[failed.cast("int").alias(letter) for letter, failed in conditions(F.col("text")).items()],
    )
    own = stage(own.groupBy("id", "part", "same", *FILTERS[:4]).agg(F.count(F.lit(1)).alias("n")), "failed")
    first = own.groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    known = known.agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic")
    )
    joined = own.join(first, ["same", "id"], "left").join(known, "id", "left")
    copy = (F.col("id").isNotNull() & F.col("first").isNull()).cast("int")
    return (
        joined.withColumn("E", copy)
        .groupBy("part", *FILTERS)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
        )
    )


def _selections() -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """All orders, the filter of each order's steps, and per measure what each step selects along each filter."""
    orders = ["".join(order) for order in itertools.permutations(FILTERS)]
    steps = [(order, i) for order in orders for i in range(len(FILTERS))]

    def select(before, here, after):
        table = np.empty((len(FILTERS), len(steps), 2), np.int64)
        for row, (order, i) in enumerate(steps):
            for place, letter in enumerate(order):
                table[FILTERS.index(letter), row] = before if place < i else here if place == i else after
        return table

    chosen = {
        "kept": select(_PASS, _PASS, _ALL),
        "removed": select(_PASS, _FAIL, _ALL),
        "failing": select(_ALL, _FAIL, _ALL),
        "unique": select(_PASS, _FAIL, _PASS),
    }
    return orders, np.array([FILTERS.index(order[i]) for order, i in steps]), chosen


def contracted(tensor: np.ndarray) -> pd.DataFrame:
    """A row per order and step of a tensor of counts: measure, then pass or fail along each filter."""
    orders, letters, chosen = _selections()

    def counts(measure: str, selection: str) -> np.ndarray:
        table = tensor[MEASURES.index(measure)]
        return np.einsum("abcde,sa,sb,sc,sd,se->s", table, *chosen[selection], optimize=True)

    removed = counts("n", "removed")
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, letters, removed)
    return pd.DataFrame(
        {
            "filter_order": np.repeat(orders, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders)),
            "kept": counts("n", "kept"),
            "removed": removed,
            "redundant": counts("n", "failing") - removed,
            "unique_fails": counts("n", "unique"),
            "good_lost": counts("good", "removed"),
            "toxic_lost": counts("toxic", "removed"),
            "shapley": shapley[letters],
        }
    )


def _audit(rows: pd.DataFrame) -> pd.DataFrame:
    tensor = np.zeros((len(MEASURES), *(2,) * len(FILTERS)), np.int64)
    cells = tuple(rows[letter].to_numpy() for letter in FILTERS)
    for number, measure in enumerate(MEASURES):
        np.add.at(tensor[number], cells, rows[measure].to_numpy())
    table = contracted(tensor)
    table.insert(0, "part", rows["part"].iloc[0])
    return table


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """What each filter removes at each step of each order, per part of the documents.

    Result: part, filter_order (all 120), step (1 to 5; its filter is that
    letter of the order), kept, removed, redundant (failing the filter, removed
    earlier), unique_fails (failing this filter only), good_lost and toxic_lost
    (removed here, with such a label), shapley (what the filter removes, over
    all orders). The filters: A under 100 words; B under 80 % distinct words;
    C over 10 % capitals; D symbols; E the text of a smaller id. Steps that
    remove nothing are there with zeros.

    A null text is empty; a null part is the part ''. A row without id never
    is a copy, nor is its text the first of others; repeated rows of one id are
    not copies of each other. ``labels`` (doc_id, quality, toxic) counts an id
    as good or toxic if any of its rows does; rows without one are neither.
    Without documents there are no parts. Extra columns are ignored.

    A part has at most 32 counts, which one task contracts; all else is
    joined and added up by Spark.
    """
    counts = failures(docs, labels, part)
    ddl = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in _COUNTS)
    return counts.groupBy("part").applyInPandas(_audit, ddl)
