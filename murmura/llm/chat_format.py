"""Chat formatting by prefix-target expansion."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm.text import join_same, whole

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BLOCK = 1000


def escaped(text: Column) -> Column:
    """No control string is left; ``unescaped`` gives the text back."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted_turns(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every turn in its template, with its place in the conversation's text.

    Result: conv_id, block, place, turn, role, piece, start, target_start,
    target_end, end. The pieces of a conversation in order of ``place`` are
    its text; start and end count code points from its beginning. The target
    of an assistant's turn is its escaped text, without the marks around it.

    Rows are ordered by turn, null last, then role and text, so that equal
    rows are interchangeable. A null role or text is empty. Rows without
    conv_id are one conversation. Backslashes in a role, and line feeds,
    are escaped like control strings.

    Offsets are running sums over blocks of ``block`` turn numbers, whose
    lengths are summed up before, so that a very long conversation is spread
    over many tasks.
    """
    role = F.replace(escaped(whole("role")), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = escaped(whole("text"))
    rows = conversations.select("conv_id", "turn", whole("role").alias("role"), head.alias("head"), body.alias("body"))
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        F.floor(F.col("turn") / block).alias("block"),
        F.concat("head", "body", F.lit(CLOSE + "\n")).alias("piece"),
        F.length("head").cast("long").alias("head_chars"),
        F.length("body").cast("long").alias("body_chars"),
    ).withColumn("chars", F.length("piece").cast("long"))
    sums = rows.groupBy("conv_id", "block").agg(F.sum("chars").alias("sum"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("block"))
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("chars_ahead"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_ahead"),
    )
    order = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_last("turn"), "role", "piece")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({"upto": F.sum("chars").over(upto), "number": F.row_number().over(order)})
    placed = join_same(placed, sums, ["conv_id", "block"])
    start = F.col("chars_ahead") + F.col("upto") - F.col("chars")
    target = start + F.col("head_chars")
    return placed.select(
        "conv_id",
        "block",
        (F.col("turns_ahead") + F.col("number") - 1).alias("place"),
        "turn",
        "role",
        "piece",
        start.alias("start"),
        target.alias("target_start"),
        (target + F.col("body_chars")).alias("target_end"),
        (start + F.col("chars")).alias("end"),
    )


def prefix_targets(turns: DataFrame) -> DataFrame:
    """An example for each assistant turn: all earlier turns are context, only the reply is trained.

    Result: conv_id, place (of the reply), n_context, target_start,
    target_end, end. The example is the conversation's text up to ``end``
    and its loss mask is target_start to target_end. Examples point into the
    text that all of them share, for written out they would take the square
    of a conversation's length; ``example_texts`` writes chosen ones out.
    """
    replies = turns.filter(F.col("role") == "assistant")
    return replies.select(
        "conv_id", "place", F.col("place").alias("n_context"), "target_start", "target_end", "end"
    )


def example_texts(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """conv_id, place, text, target_start, target_end: each example with its whole prefix written out.

    One row holds the whole prefix, as a trainer reads it; leave out
    examples that are longer than the trainer's context first.
    """
    wanted = examples.select("conv_id", F.col("place").alias("upto"), "target_start", "target_end")
    pieces = join_same(turns.select("conv_id", "place", "piece"), wanted, ["conv_id"])
    gathered = (
        pieces.filter("place <= upto")
        .groupBy("conv_id", "upto", "target_start", "target_end")
        .agg(F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("pieces"))
    )
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return gathered.select("conv_id", F.col("upto").alias("place"), text.alias("text"), "target_start", "target_end")


_PIECE = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!\|))*)<\|im_end\|>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)

_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_examples", pa.int64()),
    ]
)


class _Reader:
    """Reads one conversation back, piece by piece, holding no more than a piece."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss_chars = self.examples = 0

    def read(self, piece: str, mask: tuple[int, int] | None) -> None:
        found = _PIECE.fullmatch(piece)
        role, text = (_ESCAPE.sub(r"\1", part) for part in found.groups())
        self.turns.update(f"{role}\n{text}\n".encode())
        if mask is not None:
            target = _ESCAPE.sub(r"\1", piece[mask[0] - self.chars : mask[1] - self.chars])
            self.loss.update(target.encode())
            self.loss_chars += len(target)
            self.examples += 1
        self.n += 1
        self.chars += len(piece)

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.n,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
            self.examples,
        )


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, rows = None, []

    def table():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DIGEST)], schema=_DIGEST)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "piece", "mask_start", "mask_end")]
        for conv_id, piece, start, end in zip(*columns):
            if reader is None or reader.conv_id != conv_id:
                if reader is not None:
                    rows.append(reader.row())
                reader = _Reader(conv_id)
            reader.read(piece, None if start is None else (start, end))
        if len(rows) >= 1000:
            yield table()
            rows.clear()
    if reader is not None:
        rows.append(reader.row())
    if rows:
        yield table()


def read_back(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """What the formatted output says of each conversation.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed per
    turn), loss_chars and loss_sha256 (all text under the masks, unescaped),
    formatted_chars (of the conversation's formatted text), n_examples.
    A digest needs a conversation's turns one after the other: they are sorted
    by Spark and read as a stream, so no conversation is held in memory.
    """
    masks = examples.select(
        "conv_id", "place", F.col("target_start").alias("mask_start"), F.col("target_end").alias("mask_end")
    )
    masked = join_same(turns.select("conv_id", "place", "piece"), masks, ["conv_id", "place"], "left")
    ordered = masked.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    ddl = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long, n_examples long"
    )
    return ordered.mapInArrow(_read_back, ddl)
