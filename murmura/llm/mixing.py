"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm.text import join_same, whole, word_count, words
from murmura.sources.scratch import stage

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"
RANGES = 4096


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES
) -> DataFrame:
    """Words that the mix takes of each source: source, source_size, target.

    Sources in code point order, null last, get the weights in turn. They
    share the sum of all sizes by weight; no target exceeds ``copies`` times
    the source, and what is above is shared again by weight. In closed form:
    sources ordered by how little they can give per weight are full up to a
    point, and the rest share what is left. One row per source is all that is
    ordered globally.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    most = F.lit(copies) * F.col("source_size")
    ranked = totals.withColumns({"place": place, "weight": weight.cast("long")})
    order = Window.orderBy((most / F.col("weight")).asc(), F.col("place").asc())
    everything = Window.partitionBy()
    queue = ranked.withColumns(
        {
            "rank": F.row_number().over(order),
            "left": F.sum("source_size").over(everything)
            - F.coalesce(F.sum(most).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "share": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    full = most * F.col("share") <= F.col("weight") * F.col("left")
    first_free = F.min(F.when(~full, F.struct("rank", "left", "share"))).over(everything)
    free = F.col("weight").cast("double") * F.col("free.left").cast("double") / F.col("free.share")
    return queue.withColumns({"full": full, "free": first_free}).select(
        "source",
        "source_size",
        F.when(F.col("full"), most.cast("double")).otherwise(free).alias("target"),
    )


def fair_queue(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    copies: int = MAX_COPIES,
    seed: str = SEED,
    budget: int | None = None,
) -> DataFrame:
    """Each document's place in its source's queue and the words taken of it.

    ``docs`` needs doc_id, source and text; further columns are ignored.
    Result, one row per row of ``docs``: doc_id, version (hash of the text),
    source, size, source_size, target, ahead (words of the same source queued
    before it), served (words taken of each copy) and taken.

    A source's documents are shuffled by a hash of their id and queue up
    ``copies`` times. Each word has a virtual finish time, the words of its
    source queued up to it / target; a document's is that of its last word.
    The queue of all words is ordered by finish time and cut at ``budget``
    words, by default the whole words of all targets and never more. The
    order is found by ranges of virtual time: words a range are summed up,
    running sums of these tell which range the cut lies in, that range is
    divided once more, and only the words of the last range are sorted.

    The running sum in a source is taken within 4,096 hash ranges, whose
    totals are summed up beforehand, so a hot source is spread over as many
    tasks.

    A null text has size 0. A null id is shuffled like an empty one. Rows with
    the same id follow each other by size, so equal rows are interchangeable.
    An empty table gives an empty result.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = stage(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("version"),
            "source",
            word_count(whole("text")).alias("size"),
            key.alias("key"),
        ),
        "mix_sizes",
    ).withColumn("range", F.substring("key", 1, 3))
    targets = stage(source_targets(sizes, weights, copies), "mix_targets")
    ranges = sizes.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("range_ahead", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    within = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    queued = sizes.withColumn("upto", F.sum("size").over(within))
    ahead = F.col("range_ahead") + F.col("upto") - F.col("size")
    placed = join_same(queued, ranges, ["source", "range"]).withColumn("ahead", ahead)
    queue = stage(
        join_same(placed, targets, ["source"]).select(
            "doc_id", "version", "source", "size", "source_size", "target", "ahead"
        ),
        "mix_queue",
    )
    whole_words = targets.agg(F.coalesce(F.sum(F.floor("target")), F.lit(0))).first()[0]
    return _cut(queue, copies, whole_words if budget is None else min(budget, whole_words))


def _by(time: Column, copy: Column) -> Column:
    """Words of a copy that have finished by a virtual time."""
    done = F.floor(time * F.col("target")) - copy * F.col("source_size") - F.col("ahead")
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), done))


def _each(queue: DataFrame, copies: int) -> DataFrame:
    return queue.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _cut(queue: DataFrame, copies: int, budget: int) -> DataFrame:
    """``queue`` with the words served of each copy until the budget is spent."""
    spots = _each(queue.filter("size > 0"), copies)
    first, steps, left = 0, RANGES, budget
    for _ in range(2):
        # A copy's words lie in the ranges (spot / steps, (spot + 1) / steps] from that of its first word on.
        begin = (F.col("copy") * F.col("source_size") + F.col("ahead")) / F.col("target")
        end = begin + F.col("size") / F.col("target")
        low = F.greatest(F.floor(begin * steps) - 1, F.lit(first))
        high = F.least(F.floor(end * steps) + 1, F.lit(first + RANGES - 1))
        held = spots.withColumn("spot", F.explode(F.when(low <= high, F.sequence(low, high))))
        words = _by((F.col("spot") + 1) / steps, F.col("copy")) - _by(F.col("spot") / steps, F.col("copy"))
        totals = held.groupBy("spot").agg(F.sum(words).alias("words"))
        upto = F.sum("words").over(Window.orderBy("spot").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = totals.withColumn("upto", upto).filter(F.col("upto") >= left).orderBy("spot").select("spot", "words", "upto").first()
        if found is None or left <= 0:
            served = [F.lit(0).cast("long")] * copies
            return queue.withColumn("served", F.array(*served)).withColumn("taken", F.lit(0).cast("long"))
        left -= found["upto"] - found["words"]
        last, over = found["spot"], steps
        first, steps = last * RANGES, steps * RANGES
    since, until = F.lit(last / over), F.lit((last + 1) / over)
    here = spots.withColumns({"from": _by(since, F.col("copy")), "to": _by(until, F.col("copy"))}).filter("to > from")
    word = here.withColumn("word", F.explode(F.sequence(F.col("from") + 1, F.col("to"))))
    ends = F.col("copy") * F.col("source_size") + F.col("ahead") + F.col("word")
    ordered = word.select("source", "ahead", "copy", (ends / F.col("target")).alias("finish"))
    ordered = ordered.orderBy("finish", F.asc_nulls_last("source"), "copy").limit(left)
    more = ordered.groupBy("source", "ahead").agg(
        *[F.count_if(F.col("copy") == copy).alias(f"more_{copy}") for copy in range(copies)]
    )
    joined = join_same(queue, more, ["source", "ahead"], "left")
    served = [
        _by(since, F.lit(copy)) + F.when(F.col("size") > 0, F.coalesce(f"more_{copy}", F.lit(0))).otherwise(0)
        for copy in range(copies)
    ]
    joined = joined.withColumn("served", F.array(*served)).drop(*[f"more_{copy}" for copy in range(copies)])
    return joined.withColumn("taken", F.aggregate("served", F.lit(0).cast("long"), lambda total, n: total + n))


def mixture(queue: DataFrame) -> DataFrame:
    """The mix in order: a row per copy taken, sorted by virtual finish time.

    Adds copy, finish and words (as many of its first words belong to the
    mix) to the columns of ``queue``. Sorted by ranges over all partitions.
    """
    each = queue.select("*", F.posexplode("served").alias("copy", "words"))
    ends = F.col("copy") * F.col("source_size") + F.col("ahead") + F.col("size")
    each = each.withColumn("finish", ends / F.col("target"))
    return each.filter("words > 0").orderBy("finish", "source", "doc_id", "copy")


def mixed_texts(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The columns of ``mix`` and text: the words that belong to the mix, in its order.

    A copy taken whole keeps its text as it is; of others the first words
    stay, joined by blanks. Texts are found by id and hash.
    """
    keys = {"_none": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("string"), F.lit(""))}
    texts = docs.select(F.xxhash64("text").alias("version"), "text", *[key.alias(name) for name, key in keys.items()])
    # Grouped and joined by the same keys, none of them missing, so that texts are shuffled once for both.
    texts = texts.groupBy("_none", "_id", "version").agg(F.first("text").alias("text"))
    found = mix.withColumns(keys).join(texts, ["_none", "_id", "version"])
    cut = F.array_join(F.slice(words(F.col("text")), F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(cut)
    return found.select(*mix.columns, text.alias("text")).orderBy("finish", "source", "doc_id", "copy")
