"""Near-duplicate documents by fast similarity sketching."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.components import components
from murmura.llm.hashing import NOT_SPACE, chunks, grams, mix, split_words
from murmura.llm.text import join_same
from murmura.sources.scratch import stage

SHINGLE = 5
PERCENT = 80
BANDS = 40
ROWS = 4
FIRST_PIVOTS = 4


def shingle_sets(words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, end to end; and their bounds.

    A text of fewer words than ``size`` but at least one is one shingle.
    """
    hashes = grams(words.hashes, size)
    sets = []
    for begin, end in zip(words.bounds[:-1], words.bounds[1:]):
        if end - begin >= size:
            sets.append(np.unique(hashes[begin : end - size + 1]))
        elif end > begin:
            sets.append(grams(words.hashes[begin:end], int(end - begin)))
        else:
            sets.append(hashes[:0])
    bounds = np.cumsum([0, *map(len, sets)])
    return np.concatenate(sets) if sets else hashes[:0], bounds


def fast_sketch(items: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """A sketch of ``size`` coordinates for each set.

    In a round every item of a set is thrown into one of the coordinates by a
    fresh hash, and an empty coordinate keeps the least value thrown into it.
    After ``size`` such rounds, round ``size + i`` throws all items into
    coordinate i, so every coordinate is filled. A set is done as soon as all
    its coordinates are; two sets agree in a coordinate with a probability of
    their Jaccard similarity. Empty sets keep empty sketches.
    """
    n = len(bounds) - 1
    none = np.uint64(2**64 - 1)
    sketch = np.full((n, size), none, np.uint64)
    counts = np.diff(bounds)
    open_sets = np.flatnonzero(counts)
    items = items[np.repeat(counts > 0, counts)]
    owner = np.repeat(np.arange(n), counts)
    for round_ in range(2 * size):
        if not len(open_sets):
            break
        thrown = mix(items ^ mix(np.array([round_ + 1], np.uint64))[0])
        if round_ < size:
            place = ((thrown >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.full(len(items), round_ - size)
        # The low bits pick the least item; the round goes first, as later rounds only fill gaps.
        value = mix(thrown) >> np.uint64(1)
        flat = sketch.reshape(-1)
        cell = owner * size + place
        free = flat[cell] == none
        fresh = np.full(n * size, none, np.uint64) if free.any() else None
        if fresh is not None:
            np.minimum.at(fresh, cell[free], value[free])
            flat[...] = np.where(flat == none, fresh, flat)
        done = (sketch[open_sets] != none).all(axis=1)
        if done.any():
            open_sets = open_sets[~done]
            still = np.zeros(n, bool)
            still[open_sets] = True
            keep = still[owner]
            items, owner = items[keep], owner[keep]
            if 2 * len(open_sets) < n and len(open_sets):
                # Go on with the open sets alone, in arrays of their own.
                renamed = np.searchsorted(open_sets, owner)
                sketch[open_sets] = _finish(items, renamed, sketch[open_sets], round_ + 1, size)
                break
    return sketch


def _finish(
    items: np.ndarray, owner: np.ndarray, sketch: np.ndarray, first: int, size: int
) -> np.ndarray:
    """The remaining rounds for sets that are still open."""
    none = np.uint64(2**64 - 1)
    out, rows = sketch.copy(), np.arange(len(sketch))
    for round_ in range(first, 2 * size):
        thrown = mix(items ^ mix(np.array([round_ + 1], np.uint64))[0])
        if round_ < size:
            place = ((thrown >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.full(len(items), round_ - size)
        value = mix(thrown) >> np.uint64(1)
        fresh = np.full(sketch.size, none, np.uint64)
        np.minimum.at(fresh, owner * size + place, value)
        sketch = np.where(sketch == none, fresh.reshape(sketch.shape), sketch)
        done = (sketch != none).all(axis=1)
        if done.any():
            out[rows[done]] = sketch[done]
            rows, kept = rows[~done], np.flatnonzero(~done)
            sketch = sketch[kept]
            keep = ~done[owner]
            items, owner = items[keep], np.searchsorted(kept, owner[keep])
        if not len(rows):
            break
    return out


def _signatures(shingle: int, bands: int, rows: int):
    fields = [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(batch.column("text"), NOT_SPACE)
        items, bounds = shingle_sets(words, shingle)
        sketch = fast_sketch(items, bounds, bands * rows).reshape(-1, bands, rows)
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64), sketch.shape[:2])
        for row in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sketch[:, :, row])
        flat = pa.array(key.reshape(-1).view(np.int64))
        offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * bands)
        digests = []
        for seed in (1, 2):
            sums = np.zeros(len(items) + 1, np.uint64)
            np.cumsum(mix(items + np.uint64(seed)), out=sums[1:])
            digests.append(pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)))
        arrays = [
            batch.column("doc_id"),
            pa.array(np.diff(bounds).astype(np.int64)),
            *digests,
            pa.ListArray.from_arrays(offsets, flat),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield one(part)

    return run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sets(shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                items, bounds = shingle_sets(split_words(part.column("text"), NOT_SPACE), shingle)
                offsets = pa.array(bounds.astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(items.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], schema=schema)

    return run, "doc_id long, shingles array<long>"


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def _met(buckets: DataFrame, rank: Column, percent: int) -> DataFrame:
    """Each member of a bucket with the one of least rank, its pivot.

    Distinct pairs whose sizes allow the similarity, the lower id first.
    """
    pivots = buckets.groupBy("band").agg(F.min_by(F.struct("x", "n"), rank).alias("pivot"))
    both = buckets.join(pivots, "band").select("x", "n", F.col("pivot.x").alias("y"), F.col("pivot.n").alias("m"))
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    met = both.filter((F.col("x") != F.col("y")) & fits)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _ranked_prefixes(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each member that a linked partner must share one of.

    (x, root, n, at, item): ``at`` counts from 0 in order of rarity among the
    members, then of the hash.
    """
    own = sets.select(F.col("doc_id").alias("x"), "shingles").join(members, "x")
    # A repeated row has the same set, hence the digest and the distinct items.
    own = own.select("x", "root", F.size("shingles").alias("n"), F.xxhash64("shingles").alias("digest"), "shingles")
    items = own.select("x", "root", "n", "digest", F.explode("shingles").alias("item"))
    rarity = items.groupBy("item").agg(F.count(F.lit(1)).alias("held"))
    placed = F.array_sort(F.collect_set(F.struct("held", "item")))
    sorted_sets = items.join(rarity, "item").groupBy("x", "root", "n", "digest").agg(placed.alias("placed"))
    least_shared = F.ceil(F.col("n") * percent / 100).cast("int")
    prefix = F.slice("placed", F.lit(1), F.col("n") - least_shared + 1)
    each = sorted_sets.select("x", "root", "n", F.posexplode(prefix).alias("at", "placed"))
    return each.select("x", "root", "n", "at", F.col("placed.item").alias("item"))


def _prefix_pairs(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components that may be linked; no linked pair is left out.

    With items in one order, the first common item of two sets at places i
    and j bounds their overlap by min(n - i, m - j). What the similarity
    demands of the overlap therefore bounds how late that item may come in
    either set, and more tightly in the smaller one. Near copies that differ
    in too many places have too many rare items ahead of their common ones.
    """
    wide = _ranked_prefixes(sets, members, percent)

    def demanded(n, m):
        return F.ceil((n + m) * percent / (100 + percent))

    narrow = wide.filter(F.col("at") <= F.col("n") - demanded(F.col("n"), F.col("n")))
    narrow = narrow.select(
        "item",
        F.col("x").alias("y"),
        F.col("n").alias("m"),
        F.col("root").alias("root_y"),
        F.col("at").alias("at_y"),
    )
    smaller = (F.col("m") < F.col("n")) | (F.col("m") == F.col("n")) & (F.col("y") < F.col("x"))
    overlap = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("at_y"))
    met = wide.join(narrow, "item").filter(
        smaller
        & (F.col("root") != F.col("root_y"))
        & (100 * F.col("m") >= percent * F.col("n"))
        & (overlap >= demanded(F.col("n"), F.col("m")))
    )
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of near-duplicates: doc_id, n_shingles, component_id, kept; a row per row of ``docs``.

    Documents are linked when the Jaccard similarity of their sets of word
    shingles is at least ``percent`` percent; a component is what links reach.

    1. Each text becomes a fast similarity sketch, whose bands are hashed.
    2. Equal sets form a class, and its smallest id goes on for all.
    3. Members of a band's bucket are compared with one of them, a pivot, on
       the full sets, and then with the member that has most links so far, the
       middle of a group of near copies: a few pairs per member, however large
       the group is. Buckets that then lie in one component are done.
    4. Members of buckets that still hold several components are compared by
       the prefixes of their sets in order of rarity: an exact filter, which
       leaves no linked pair out and passes hardly any other.

    With 40 bands of 4 coordinates a pair at 85 percent shares no bucket with
    a probability of 2e-13, one at 80 percent of 7e-10. Shingles are compared
    by 64-bit hashes.

    Null and empty texts, and texts without words, have empty sets and are
    linked with nothing. Rows without id belong to the class of an equal set
    if some row of it has an id, and else stand alone with a null
    component_id; they are kept only in that case. Rows with the same id are
    one node of the links. Further columns of ``docs`` are ignored; an empty table
    gives an empty result.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    signed = stage(texts.mapInArrow(*_signatures(shingle, bands, rows)), "signatures")
    key = ["n_shingles", "set_a", "set_b"]
    # Grouped by a dependent key as well, so that the join that follows brings
    # its own exchange and adaptive execution can split a very large class.
    classes = signed.filter("n_shingles > 0").groupBy(*key, F.hash("set_a").alias("dependent"))
    classes = classes.agg(F.min("doc_id").alias("chief")).drop("dependent")
    members = stage(
        signed.drop("bands").join(classes, key, "left").select("doc_id", "n_shingles", "chief"), "members"
    )
    chiefs = members.filter("doc_id = chief").select("doc_id", "n_shingles").distinct()
    banded = (
        signed.join(chiefs, ["doc_id", "n_shingles"], "left_semi")
        .select(F.col("doc_id").alias("x"), F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    )
    crowded = banded.groupBy("band").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    crowded = crowded.filter("low < high").select("band")
    buckets = stage(banded.join(crowded, "band"), "buckets")

    wanted = buckets.select(F.col("x").alias("doc_id")).distinct()
    sets = stage(texts.join(wanted, "doc_id", "left_semi").mapInArrow(*_sets(shingle)), "sets")

    # A few members in turn, so that a large group shows who is in its middle.
    lot = F.struct(F.xxhash64("x", F.pmod("band", F.lit(FIRST_PIVOTS))), "x")
    links = stage(_verified(_met(buckets, lot, percent), sets, percent), "links")
    degrees = links.select(F.explode(F.array("a", "b")).alias("x")).groupBy("x")
    degrees = degrees.agg(F.count(F.lit(1)).alias("degree"))
    middle = F.struct(-F.coalesce("degree", F.lit(0)), "x")
    met = _met(buckets.join(degrees, "x", "left"), middle, percent)
    links = links.unionByName(stage(_verified(met, sets, percent), "links"))
    placed = _mixed(buckets, components(links))
    met = _prefix_pairs(sets, placed.select("x", "root").distinct(), percent)
    labels = components(links.unionByName(stage(_verified(met, sets, percent), "links")))

    named = labels.select(F.col("node").alias("chief"), "root")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("root", "chief"))
    joined = members.join(named, "chief", "left").withColumn("component_id", component)
    return joined.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets whose members lie in more than one component, with their roots."""
    named = labels.select(F.col("node").alias("x"), F.col("root").alias("known"))
    placed = buckets.join(named, "x", "left").withColumn("root", F.coalesce("known", "x")).drop("known")
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return stage(placed.join(mixed.filter("low < high").select("band"), "band"), "mixed_buckets")


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest id of each component."""
    kept = near_duplicates(docs, **settings).filter("kept").select("doc_id").distinct()
    return join_same(docs, kept, ["doc_id"], "left_semi")
