"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.bindings import prepared
from murmura.llm import (
    chat_format,
    decontamination,
    filter_audit,
    html_text,
    language_id,
    mixing,
    near_dedup,
    periodic_runs,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    toxicity,
)
from murmura.llm.text import whole, words
from murmura.sources.scratch import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register ``function`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepared(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.read.schema(schema).parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("item_id bigint, text string").parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, quality int, toxic int").parquet(f"{sf_dir}/labels.parquet")


@query
def op1_line_frequency(spark, d):
    return quality_rules.line_frequency(documents(spark, d))


@query
def op2_weighted_fair_queueing(spark, d):
    queue = mixing.fair_queue(documents(spark, d))
    return queue.select("doc_id", "size", "source_size", "target", "taken")


def _said(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _number(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query
def op3_blob_ledger(spark, d):
    docs = documents(spark, d).select("doc_id", "text")
    base = [rule.kind for rule in secret_scan.BASE]
    of_base = F.filter("secrets", lambda s: s["kind"].isin(base))
    return secret_scan.secrets(docs).select(
        "doc_id",
        *[_number("secrets", kind).alias(f"n_{kind}") for kind in base],
        F.sha2(_said(of_base), 256).alias("base_sha256"),
        _said(F.col("secrets")).alias("spans"),
    )


@query
def op4_candidate_boosting(spark, d):
    base = F.filter("spans", lambda s: s["kind"].isin(list(pii.BASE)))
    return pii.personal_data(documents(spark, d)).select(
        "doc_id",
        *[_number("spans", kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(_said(base), 256).alias("base_sha256"),
        _said(F.col("spans")).alias("spans"),
    )


@query
def op5_prefix_targets(spark, d):
    schema = "conv_id bigint, turn bigint, role string, text string"
    talks = spark.read.schema(schema).parquet(f"{d}/conversations.parquet")
    tricky = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], schema)
    turns = stage(chat_format.formatted_turns(talks.unionByName(added)), "turns")
    return chat_format.read_back(turns, chat_format.prefix_targets(turns))


@query
def op6_winnowing(spark, d):
    found = decontamination.contamination(documents(spark, d), benchmark(spark, d))
    return found.drop("version")


@query
def op7_segmentation_unigrams(spark, d):
    return language_id.language_id(documents(spark, d))


@query
def op8_text_to_tag_ratio(spark, d):
    pages = spark.read.schema("page_id bigint, url string, html string").parquet(f"{d}/pages.parquet")
    return html_text.extract_pages(pages)


@query
def op9_fast_similarity_sketching(spark, d):
    return near_dedup.near_duplicates(documents(spark, d), shingle=3, percent=85)


@query
def op10_empirical_bayes(spark, d):
    known = labels(spark, d).select("doc_id", F.col("quality").alias("label"))
    return quality_classifier.quality(documents(spark, d), known).drop("version")


def _checksum(id: str) -> Column:
    """CRC-32 of the decimal id; null without id."""
    return F.crc32(F.col(id).cast("string"))


@query
def op11_ftrl_proximal(spark, d):
    held_out = F.coalesce(_checksum("doc_id") % 3 == 1, F.lit(False))
    known = labels(spark, d).select("doc_id", F.col("toxic").alias("label")).filter(~held_out)
    found = toxicity.toxicity(documents(spark, d), known, at_least=0.7)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; for a tenth of the ids, from word a on the p words there over and over."""
    checksum = _checksum("doc_id")
    docs = docs.select("doc_id", "text", F.when(checksum % 10 == 0, words(whole("text"))).alias("said"))
    n, g = F.size("said"), F.floor(checksum / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    block = F.flatten(F.array_repeat(F.slice("said", a + 1, p), times))
    planted = F.array_join(F.concat(F.slice("said", F.lit(1), a), F.slice(block, F.lit(1), n - a)), " ")
    return docs.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op12_frequency_splitting(spark, d):
    found = periodic_runs.periodic_runs(_planted(documents(spark, d)))
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    # Runs stand in order of start and period, so the first of equal ones stays.
    best = F.aggregate(
        "runs",
        nothing,
        lambda top, run: F.when(
            top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run
        ).otherwise(top),
    )
    said = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(said, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_contingency_tensor(spark, d):
    return filter_audit.filter_audit(documents(spark, d), labels(spark, d))
