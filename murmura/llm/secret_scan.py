"""Secret scans over a ledger of blobs that have been scanned before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.arrays import between, let, running, text_pieces
from murmura.llm.text import fresh_name, whole
from murmura.sources.scratch import fresh_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret; raise ``version`` when the pattern changes.

    ``needs`` is a literal that every match contains, to skip most texts.
    Matches whose ``group`` is shorter than ``least`` are dropped.
    """

    kind: str
    pattern: str
    version: int = 1
    needs: str = ""
    group: int = 0
    least: int = 1


ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    Rule("assign", ASSIGN, group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", needs="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", needs="gh"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}", needs="xox"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="eyJ"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35,}", needs="AIza"),
)
RULES = BASE + MORE

LEDGER = "blob string, kind string, version int, spans array<struct<start:long,end:long>>"
SPAN = "array<struct<start:long,end:long>>"


def rule_spans(text: Column, rule: Rule) -> Column:
    """Start and end (exclusive, code points) of the matches of a rule.

    The pieces between matches and the matches themselves alternate, so
    running sums of their lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.transform(
        F.arrays_zip(matches.alias("match"), values.alias("value"), gaps.alias("gap")),
        lambda part: F.struct(
            (F.length(part["gap"]) + F.length(part["match"])).cast("long").alias("end"),
            F.length(part["match"]).alias("size"),
            F.length(part["value"]).alias("value"),
        ),
    )
    places = running(
        parts,
        lambda before, part: F.struct(
            (before["end"] + part["end"]).alias("end"), part["size"].alias("size"), part["value"].alias("value")
        ),
    )
    # What follows the last match has no match of its own and is dropped here, too.
    found = F.transform(
        F.filter(places, lambda part: part["value"] >= rule.least),
        lambda part: F.struct((part["end"] - part["size"]).alias("start"), part["end"].alias("end")),
    )
    possible = text.contains(rule.needs) & text.rlike(rule.pattern) if rule.needs else text.rlike(rule.pattern)
    return F.when(possible, found).otherwise(F.array().cast(SPAN))


def read_ledger(spark, path: str) -> DataFrame:
    """Scanned pairs so far; none when nothing has been written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/run=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_unseen(versions: DataFrame, ledger: str, run: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger has not seen and append it as ``run``.

    ``versions`` has blob and text, one row per version of every path. Equal
    texts are one blob, joined up in each task before the shuffle, so a text
    with very many copies is scanned once and is no hot key. A blob is scanned
    by those rules whose current version has not seen it. Repeating a run
    replaces its own rows.
    """
    spark = versions.sparkSession
    known = read_ledger(spark, ledger).groupBy("blob").agg(
        F.collect_set(F.struct("kind", "version")).alias("seen")
    )
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    pairs = blobs.join(known, "blob", "left")
    text = F.col("text")

    def finding(rule: Rule) -> Column:
        pair = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))
        new = ~F.coalesce(F.array_contains("seen", pair), F.lit(False))
        row = F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            rule_spans(text, rule).alias("spans"),
        )
        return F.when(new, row)

    found = pairs.select("blob", F.explode(F.array_compact(F.array(*map(finding, rules)))).alias("row"))
    found.select("blob", "row.*").write.mode("overwrite").parquet(f"{ledger}/run={run}")


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All spans of each blob with any, by start and then rule: blob, spans."""
    order = F.element_at(
        F.create_map(*[F.lit(x) for i, rule in enumerate(rules) for x in (f"{rule.kind}:{rule.version}", i)]),
        F.concat_ws(":", "kind", "version"),
    )
    current = ledger.withColumn("place", order).filter("place IS NOT NULL AND size(spans) > 0")
    each = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            F.col("place").alias("place"),
            s["end"].alias("end"),
            F.col("kind").alias("kind"),
        ),
    )
    # A dependent key, so that a join with the paths can split a blob of very many paths.
    gathered = current.groupBy("blob", F.hash("blob").alias("dependent")).agg(
        F.flatten(F.collect_list(each)).alias("spans")
    )
    return gathered.select("blob", F.array_sort("spans").alias("spans"))


def secrets(
    docs: DataFrame,
    ledger: str | None = None,
    run: str = "0",
    rules: tuple[Rule, ...] = RULES,
    name: str = "secrets",
) -> DataFrame:
    """The rows of ``docs`` with the column ``name``: kind, start and end of each span.

    ``docs`` holds every version of every path and needs the column text. The
    ledger is a folder that later runs pass again; by default a new one. All
    columns stay, but for one of that name. Null and empty texts hold no
    secret; equal rows get equal results.
    """
    spark = docs.sparkSession
    ledger = ledger or fresh_path(spark, "ledger")
    blob = fresh_name(docs, "blob")
    named = docs.drop(name).withColumn(blob, F.sha2(whole("text"), 256))
    scan_unseen(named.select(F.col(blob).alias("blob"), whole("text").alias("text")), ledger, run, rules)
    found = findings(read_ledger(spark, ledger), rules)
    found = found.select(F.col("blob").alias(blob), F.col("spans").alias(name))
    empty = F.array().cast("array<struct<start:long,place:int,end:long,kind:string>>")
    return named.join(found, blob, "left").withColumn(name, F.coalesce(name, empty)).drop(blob)


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by a mask.

    ``spans`` are sorted by start. A span that begins before an earlier one
    has ended belongs to that one's mask. Null stays null; without spans the
    text stays as it is.
    """
    ends = running(F.transform(spans, lambda s: s["end"]), lambda before, end: F.greatest(before, end))

    def joined(reach: Column, pieces: Column) -> Column:
        def part(span: Column, i: Column) -> Column:
            before = F.coalesce(F.get(reach, i - 1), F.lit(0).cast("long"))
            return F.when(
                span["start"] >= before, F.concat(between(pieces, before, span["start"]), F.lit(mask))
            )

        rest = between(pieces, F.element_at(reach, -1), F.length(text).cast("long"))
        return F.concat(F.array_join(F.transform(spans, part), ""), rest)

    masked = let(ends, lambda reach: let(text_pieces(text), lambda pieces: joined(reach, pieces)))
    return F.when(F.size(spans) > 0, masked).otherwise(text)
