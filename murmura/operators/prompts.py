"""Prompt contexts, prompts and chat transcripts as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from murmura.functions import csv_line, latin1_fold, utc
from murmura.operators.late import late_top_k_per_group
from murmura.operators.order import numbered, running_totals


def _context_columns(df: DataFrame, by: str) -> list[str]:
    wanted = ["title", "body", by, "score", "num_comments"]
    return [c for c in wanted if c in df.columns]


def _joined(lines: Column) -> Column:
    """Collected ``(position..., line)`` structs in order, one line each."""
    return F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), "\n")


def context_of_sample(
    sample: DataFrame, by: str = "subreddit", rank: str = "rank"
) -> DataFrame:
    """One CSV text with header per group from ranked rows, as ``(by, n_rows, context)``."""
    columns = _context_columns(sample, by)
    lines = sample.select(by, rank, csv_line(*[F.col(c) for c in columns]).alias("line"))
    grouped = lines.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.collect_list(F.struct(rank, "line")).alias("lines")
    )
    header = F.lit(",".join(columns) + "\n")
    return grouped.select(by, "n_rows", F.concat(header, _joined(F.col("lines"))).alias("context"))


def prompt_context(
    posts: DataFrame,
    n: int = 15,
    by: str = "subreddit",
    ts: str = "created_utc",
    key: str = "id",
) -> DataFrame:
    """The ``n`` newest posts of every group as one CSV text per group.

    Groups, times and ids are ranked first; the texts of other posts are
    dropped where they are read and never shuffled, however many groups there
    are. A text holds at most ``n`` posts, whatever the size of its group.
    """
    columns = list(dict.fromkeys([*_context_columns(posts, by), by, ts, key]))
    dated = posts.select(*columns, utc(posts, ts).alias("_at"))
    order = [F.desc_nulls_last("_at"), F.asc(key)]
    # Posts that agree in group, time and id are told apart by their content.
    ties = [F.xxhash64(*columns)]
    sample = late_top_k_per_group(dated, by, ["_at", key], order, ties, n, found_by=[key])
    return context_of_sample(sample, by)


def joint_context(contexts: DataFrame, groups: Sequence[str], by: str = "subreddit") -> DataFrame:
    """One CSV text for the named groups, in their order, under a single header."""
    position = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col(by))
    header = F.substring_index("context", "\n", 1)
    rows = F.expr("substring(context, locate('\n', context) + 1)")
    picked = contexts.filter(F.col(by).isin(list(groups))).select(
        "n_rows", header.alias("header"), F.struct(position.alias("p"), rows.alias("line")).alias("x")
    )
    return picked.agg(
        F.sum("n_rows").alias("n_rows"),
        F.concat_ws("\n", F.max("header"), _joined(F.collect_list("x"))).alias("context"),
    )


def joint_contexts(
    contexts: DataFrame, groups_per_page: int = 50, by: str = "subreddit"
) -> DataFrame:
    """The CSV texts of all groups, by name, under one header per page: ``(page, n_rows, context)``.

    A page holds ``groups_per_page`` groups, so that a row is bounded however
    many groups there are. Only the names are ordered, by ranges.
    """
    names = numbered(contexts, by, "p").withColumnRenamed(by, "_name")
    placed = contexts.join(names, F.col(by).eqNullSafe(F.col("_name")))
    rows = F.expr("substring(context, locate('\n', context) + 1)")
    picked = placed.select(
        F.floor(F.col("p") / groups_per_page).alias("page"),
        "n_rows",
        F.substring_index("context", "\n", 1).alias("header"),
        F.struct("p", rows.alias("line")).alias("x"),
    )
    return picked.groupBy("page").agg(
        F.sum("n_rows").alias("n_rows"),
        F.concat_ws("\n", F.max("header"), _joined(F.collect_list("x"))).alias("context"),
    )


def build_prompts(
    contexts: DataFrame,
    instructions: Mapping[str, str] | DataFrame,
    role: str,
    by: str = "subreddit",
) -> DataFrame:
    """One prompt per context and instruction: role, data, instruction.

    A mapping of names to texts is asked of every context. A frame holds free
    questions, ``(by, name, text)``, each asked of its own group.
    """
    if isinstance(instructions, DataFrame):
        asks = instructions.select(by, F.struct("name", "text").alias("ask"))
        asked = contexts.join(asks, by)
    else:
        pairs = F.array(
            *[F.struct(F.lit(k).alias("name"), F.lit(v).alias("text")) for k, v in instructions.items()]
        )
        asked = contexts.withColumn("ask", F.explode(pairs))
    prompt = F.concat_ws(
        "\n\n",
        F.lit(role),
        F.concat(F.lit("Data (CSV):\n"), F.col("context")),
        F.concat(F.lit("Instruction: "), F.col("ask.text")),
    )
    kept = [c for c in contexts.columns if c not in ("context", "n_rows")]
    return asked.select(*kept, F.col("ask.name").alias("instruction"), prompt.alias("prompt"))


def render_transcripts(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    user_label: str = "User:",
    assistant_label: str = "Assistant:",
    placeholder: str = "No messages.",
    page_turns: int = 1000,
    spread: bool = False,
) -> DataFrame:
    """Ordered messages of each conversation as text, as ``(conversation, page, transcript)``.

    Every role but ``user`` is labelled as the assistant, a missing one as the user. A page covers
    ``page_turns`` consecutive turns, so the text of a very long conversation
    continues on further rows instead of growing without bound. Messages
    without a turn come in the order of their texts on pages of ``page_turns``
    messages of their own, numbered -1, -2 and so on. A row without turn, role and text is an empty
    conversation; one that has nothing else gets the placeholder on page 0.
    """
    label = F.when(F.coalesce(F.col(role), F.lit("user")) == "user", user_label).otherwise(assistant_label)
    block = F.concat(label, F.lit("\n"), latin1_fold(F.coalesce(F.col(text), F.lit(""))))
    nothing = F.col(turn).isNull() & F.col(role).isNull() & F.col(text).isNull()
    said = messages.select(
        conversation, F.col(turn).cast("bigint").alias("at"), F.when(~nothing, block).alias("line")
    )
    ordered = said.filter("at IS NOT NULL AND line IS NOT NULL").select(
        conversation, F.floor(F.col("at") / F.lit(page_turns)).alias("page"), "at", "line", F.lit(1).alias("times")
    )
    lines = F.flatten(F.transform("blocks", lambda x: F.array_repeat(x["line"], x["times"])))
    shown = (
        ordered.unionByName(_loose_pages(said, conversation, page_turns, spread))
        .groupBy(conversation, "page")
        .agg(F.array_sort(F.collect_list(F.struct("at", "line", "times"))).alias("blocks"))
        .select(conversation, "page", F.array_join(lines, "\n\n").alias("transcript"))
    )
    # Whether a conversation is empty takes no text.
    silent = said.groupBy(conversation).agg(F.count("line").alias("n")).filter("n = 0")
    nothing_said = silent.select(
        conversation, F.lit(0).cast("bigint").alias("page"), F.lit(placeholder).alias("transcript")
    )
    return shown.unionByName(nothing_said)


def _loose_pages(said: DataFrame, conversation: str, page_turns: int, spread: bool) -> DataFrame:
    """The messages without a turn, by page: equal ones once, with how often they stand on the page.

    Rows are numbered in the order of their texts, with ``spread`` by ranges
    of a conversation, so that one with very many is spread over the tasks.
    """
    distinct = said.filter("at IS NULL AND line IS NOT NULL").groupBy(conversation, "line").agg(
        F.count(F.lit(1)).alias("n")
    )
    last = F.col("upto")
    first = last - F.col("n") + 1
    pages = F.sequence(F.ceil(first / page_turns), F.ceil(last / page_turns))
    if spread:
        numbered_lines = running_totals(distinct, [conversation], "line", "n")
    else:
        through = W.partitionBy(conversation).orderBy("line").rowsBetween(W.unboundedPreceding, W.currentRow)
        numbered_lines = distinct.withColumn("upto", F.sum("n").over(through))
    placed = numbered_lines.select(
        conversation, "line", first.alias("first"), last.alias("last"), F.explode(pages).alias("p")
    )
    begin = F.greatest("first", (F.col("p") - 1) * page_turns + 1)
    end = F.least("last", F.col("p") * page_turns)
    return placed.select(
        conversation, (-F.col("p")).alias("page"), begin.alias("at"), "line", (end - begin + 1).cast("int").alias("times")
    )
