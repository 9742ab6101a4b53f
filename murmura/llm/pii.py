"""Personal data: generators propose spans, boosted trees choose among them."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.text import join_same
from murmura.sources.scratch import stage

MAX_TREES = 20
PRECISION = 0.95
KINDS = ("email", "ip", "card", "phone", "other")
BASE = KINDS[:4]
FORMS = ("mail", "number", "pairs")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits: what fails at its start fails later in it too.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Proposals beyond the base rules: as many forms as possible, right or wrong.
_HIDDEN = re.compile(r"(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,64}(?:\.[A-Za-z]{2,16})+")
_NUMBER = re.compile(r"\+?\(?[0-9][0-9()./\x20-]{5,30}[0-9]")
_PAIRS = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}")

_HINTS = {
    "mail": re.compile(r"mail|contact|write", re.I),
    "phone": re.compile(r"phone|tel\b|call|mobile|fax", re.I),
    "money": re.compile(r"card|visa|account|iban|pay", re.I),
    "host": re.compile(r"\bip\b|host|server|addr", re.I),
    "secret": re.compile(r"token|key|secret|passw|hash|version", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: the longest local part before an at sign, if a domain follows."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            out.append((begin, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans that the fixed rules find, by kind and then place."""
    out = [("email", *span) for span in emails(text)] if "@" in text else []
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m.group()))
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def features(text: str, begin: int, end: int) -> list[float]:
    """Form and context of a span."""
    span, before = text[begin:end], text[max(0, begin - 30) : begin]
    digits = _DIGIT.findall(span)
    groups = re.findall(r"[0-9]+", span)
    around = (text[begin - 1 : begin], text[end : end + 1])
    return [
        float(end - begin),
        float(len(digits)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(span.count(".")),
        float(span.count("-") + span.count(" ")),
        float(sum(c.isalpha() for c in span)),
        float("@" in span),
        float(span.startswith("+")),
        float("(" in span),
        float(":" in span),
        float(len(digits) >= 12 and luhn("".join(digits))),
        float(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        float(any(c.isalnum() or c in "=_\"'" for c in around)),
        *[float(hint.search(before) is not None) for hint in _HINTS.values()],
    ]


def loose_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Further forms: addresses with a spelt at sign, long numbers, hexadecimal pairs.

    Their lengths are those of the things they stand for: local parts of up
    to 64 characters (RFC 5321), labels of a domain of up to 63 (RFC 1035) and
    a last one of letters, numbers of 7 to 32 characters with their marks (a
    card of 19 digits, each group apart), 4 to 8 groups of hexadecimal digits
    (RFC 4291). The base spans have no such bounds.
    """
    if "(at)" in text or "[at]" in text:
        for m in _HIDDEN.finditer(text):
            begin = m.start() - (text[m.start() - 1 : m.start()] == " ")
            while begin and text[begin - 1] in _LOCAL and m.start() - begin < 65:
                begin -= 1
            yield "mail", begin, m.end()
    if _DIGIT.search(text):
        yield from (("number", *m.span()) for m in _NUMBER.finditer(text))
        if ":" in text:
            yield from (("pairs", *m.span()) for m in _PAIRS.finditer(text))


class _Cover:
    """How far the spans reach that begin before a place; answers without a walk over all of them."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        ordered = sorted((begin, end) for _, begin, end in spans)
        self.begins = [begin for begin, _ in ordered]
        self.ends = list(accumulate((end for _, end in ordered), max))

    def furthest(self, place: int) -> int:
        before = bisect_left(self.begins, place)
        return self.ends[before - 1] if before else -1


def further(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """The loose forms, overlapping or not, but those inside a base span."""
    cover = _Cover(base)
    for form, begin, end in loose_spans(text):
        if cover.furthest(begin + 1) < end:
            yield form, begin, end


def disguised(kind: str, span: str) -> str:
    """A base span as people write it beyond the base rules; which way follows from the span."""
    pick = zlib.crc32(span.encode())
    digits = "".join(_DIGIT.findall(span))
    if kind == "email":
        return re.sub("@", ("(at)", " (at) ", "[at]", " [at] ")[pick % 4], span, count=1)
    if kind == "ip":
        parts = [int(part) for part in span.split(".")]
        if pick % 2:  # as software derives the addresses of virtual devices
            return ":".join(f"{part:02x}" for part in [pick >> 8 & 254, pick >> 16 & 255, *parts])
        return "2002:{:02x}{:02x}:{:02x}{:02x}:0:0:0:0:1".format(*parts)
    if kind == "card":
        return (".", "/", " - ", "  ")[pick % 4].join(re.findall("[0-9]{1,4}", digits))
    own = digits[-10:] if len(digits) > 10 else digits[1:]
    area, middle, last = own[:3], own[3:-4], own[-4:]
    return (span[1:], f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}")[pick % 4]


def candidates_of(text: str, base: list[tuple[str, int, int]]) -> Iterator[dict]:
    """Loose spans to judge and, with label 1 and the place of their base span, examples to learn from.

    An example is a base span in disguise within its own context, if a
    generator proposes it there and no base rule finds it. A loose span is an
    example against (0) if something before it hints at a secret or a version
    or, but for a spelt address, nothing hints at personal data; else it has
    no label. Neither has one that overlaps a base span.
    """
    cover = _Cover(base)
    for form, begin, end in further(text, base):
        given = features(text, begin, end)
        mail, phone, money, host, secret = given[-len(_HINTS) :]
        hinted = (form == "mail" or mail or phone or money or host) and not secret
        apart = cover.furthest(end) <= begin
        yield {"form": form, "label": 0 if apart and not hinted else None, "start": begin, "end": end, "features": given}
    for kind, a, b in base:
        other = disguised(kind, text[a:b])
        before = text[max(0, a - 60) : a]
        near, begin, end = before + other + text[b : b + 30], len(before), len(before) + len(other)
        for form, first, last in further(near, base_spans(near)):
            # A number may have a sign or a bracket of its own more or less.
            if abs(first - begin) <= 1 and abs(last - end) <= 1:
                yield {"form": form, "label": 1, "start": a, "end": b, "features": features(near, first, last)}
                break


_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("version", pa.int64()),
        ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        (
            "loose",
            pa.list_(
                pa.struct(
                    [
                        ("form", pa.string()),
                        ("label", pa.int32()),
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("features", pa.list_(pa.float64())),
                    ]
                )
            ),
        ),
    ]
)
_SPAN = "struct<kind:string,start:long,end:long>"
_DDL = (
    f"doc_id long, version long, base array<{_SPAN}>, "
    "loose array<struct<form:string,label:int,start:long,end:long,features:array<double>>>"
)


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            part = batch.slice(begin, 1000)
            base, loose = [], []
            for text in part.column("text").to_pylist():
                text = text or ""
                own = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                loose.append(list(candidates_of(text, own)))
            columns = [part.column("doc_id"), part.column("version")]
            columns += [pa.array(base, _ROW.field("base").type), pa.array(loose, _ROW.field("loose").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ROW)


def _model(fit: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What adds a score to rows with features; with one class only, every row scores as that.

    A row of ``fit`` counts as often as its ``weight`` says.
    """
    sizes = {row["label"]: row["count"] for row in fit.groupBy("label").count().collect()}  # at most two
    if len(sizes) < 2:
        return lambda df: df.withColumn("score", F.lit(max(sizes, default=0.0)))
    vector = array_to_vector("features").alias("features")
    # Spark ML looks for places to split in a sample of max(10,000, maxBins ** 2) rows; so it takes all of them.
    bins = max(32, isqrt(sum(sizes.values())) + 1)
    trees = GBTClassifier(maxIter=MAX_TREES, maxDepth=3, maxBins=bins, seed=7, weightCol="weight")
    model = trees.fit(fit.select("label", "weight", vector))

    def scored(df: DataFrame) -> DataFrame:
        out = model.transform(df.withColumn("features", vector))
        return out.withColumn("score", vector_to_array("probability")[1])

    return scored


def chosen(candidates: DataFrame) -> DataFrame:
    """The candidates beyond the base rules that the trees hold for personal data.

    Trained on all labelled candidates: see ``candidates_of`` for the labels,
    which say what a span was before it was rewritten, not what the base rules
    find in it. Those with the same features count as one with a weight, so
    the trees walk over different features only, however many texts have them.
    Each form has its own trees. Half of the texts fit them, the other half
    sets their threshold: the least score of 0.5 or more from which on
    ``PRECISION`` of the labelled spans are positive. A form without positives
    there is not chosen, and one without examples against it is chosen whole.
    """
    known = candidates.filter("label IS NOT NULL").withColumn("label", F.col("label").cast("double"))
    alike = ["form", F.pmod(F.xxhash64("version"), F.lit(2)).alias("half"), "label", "features"]
    weighed = known.groupBy(*alike).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    examples = stage(weighed.sortWithinPartitions("form", "half", "label", "features"), "pii_examples")
    more = candidates.limit(0).withColumn("score", F.lit(0.0)).select("doc_id", "version", "start", "end", "score")
    for form in FORMS:
        own = examples.filter(F.col("form") == form)
        scored = _model(own.filter("half = 0"))
        step = F.floor(F.col("score") * 100).cast("int")
        bins = scored(own.filter("half = 1")).groupBy(step.alias("step")).agg(
            F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("good")
        )
        seen = {row["step"]: row for row in bins.collect()}  # at most 101 bins
        threshold, n, good = None, 0.0, 0.0
        for at in range(100, 49, -1):
            if row := seen.get(at):
                n, good = n + row["n"], good + row["good"]
            if good and good >= PRECISION * n:
                threshold = at / 100
        if threshold is not None:
            judged = candidates.filter((F.col("form") == form) & F.expr("label IS NULL OR label = 0"))
            more = more.unionByName(scored(judged).filter(F.col("score") >= threshold).select(*more.columns))
    return more


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, version (hash of the text) and spans (kind, start, end) of every row of ``docs``.

    Spans of the base rules always stay; spans of kind ``other`` are chosen
    by the trees, and of those that overlap the first stays. All are ordered by
    kind and then start, in code points. Null and empty texts have none; equal
    rows get equal results; other columns are ignored. Texts are searched where
    they are read, so nothing but spans is shuffled.
    """
    slim = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    rows = stage(slim.mapInArrow(_propose, _DDL), "pii")
    key = ["doc_id", "version"]
    each = rows.filter("size(loose) > 0").select(*key, F.explode("loose").alias("c")).select(*key, "c.*")
    more = chosen(stage(each.dropDuplicates([*key, "form", "label", "start", "end"]), "pii_candidates"))
    added = more.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("more"))
    joined = join_same(rows.drop("loose"), added, key, "left")
    first = F.array().cast("array<struct<start:long,end:long>>")
    apart = F.aggregate(
        F.coalesce("more", first),
        first,
        lambda acc, s: F.when(
            (F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= s["start"]), F.concat(acc, F.array(s))
        ).otherwise(acc),
    )
    named = F.transform(apart, lambda s: F.struct(F.lit("other").alias("kind"), s["start"], s["end"]))
    return joined.select(*key, F.concat("base", named.cast(f"array<{_SPAN}>")).alias("spans"))
