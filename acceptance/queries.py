"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import bindings as b
from murmura.functions import (
    clean_text,
    post_text,
    report_title,
    to_double,
    to_int,
    with_dates,
)
from murmura.operators import cohorts, distributions, keywords, kpis, prompts, ranking, trends
from murmura.operators.scoring import (
    lexicon_scorer,
    lexicon_sentiment,
    process_comments,
    process_posts,
    with_clean_text,
    with_sentiment,
)
from murmura.plans.job import cumulative_stats, run_job
from murmura.sources.landing import (
    combine_landings,
    in_groups,
    preview,
    read_comments,
    read_posts,
    write_landing,
)
from murmura.schemas import POSTS
from murmura.sources.colocated import write_colocated
from murmura.sources.scratch import fresh_path
from murmura.sources.tables import (
    FolderStore,
    Snapshot,
    comments_sample,
    processed_preview,
    resolve_column,
    run_sql,
    table_or_empty,
)
from murmura.streaming import landing_stream, newest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LEXICON = {"with": 0.5, "that": -0.5, "this": 1.0, "from": -1.0, "have": 0.25, "was": -0.25}
USER_STOPWORDS = ["that", "with", "tion", "ther"]
PROMPT_ROLE = "You report on invented communities. Answer in two sentences."
PROMPTS = {
    "loudest": "Which post drew most comments, and what is it about?",
    "mood": "Is the mood of these posts rising or falling?",
}


def query(function: Query) -> Query:
    """Register ``function`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return b.rounded(function(b.prepared(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


# --- projections -----------------------------------------------------------


@query
def clean_posts(spark, d):
    return b.documents(spark, d).select("id", "clean_body", "sentiment")


@query
def processed_comments(spark, d):
    raw = b.comments(spark, d).select("id", "post_id", "body", F.col("score").cast("string"))
    return process_comments(raw, b.scorer)


@query
def lenient_casts(spark, d):
    number = F.regexp_extract("props", r"(\d+)", 1)
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", number)
        .when(kind == "purchase", F.concat(number, F.lit(".0")))
        .when(kind == "signup", "nan")
        .when(kind == "error", "abc")
        .otherwise("")
    )
    return b.table(spark, d, "events").select(
        "event_id",
        to_double(text).alias("as_double"),
        to_int(text, "strict").alias("as_int_strict"),
        to_int(text, "lenient").alias("as_int_lenient"),
    )


@query
def post_dates(spark, d):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(20,0)") / F.lit(1000000)
    epoch = b.table(spark, d, "events").select("event_id", seconds.cast("string").alias("created_utc"))
    return with_dates(epoch).drop("created_utc")


@query
def post_texts(spark, d):
    text = post_text(F.col("title"), F.col("body"))
    return b.documents(spark, d).select("id", clean_text(text).alias("text"))


@query
def report_titles(spark, d):
    return b.documents(spark, d).select("id", report_title(F.col("body")).alias("title"))


@query
def scatter_rows(spark, d):
    return distributions.scatter_rows(b.posts(spark, d))


# --- filters, loads, ad-hoc SQL --------------------------------------------


@query
def posts_of_groups(spark, d):
    return b.posts(spark, d).filter(in_groups("src1 , src2,src3")).select("id", "title", "score")


@query
def preview_of_processed_posts(spark, d):
    return processed_preview(b.posts(spark, d).orderBy("id"))


@query
def sample_of_comments(spark, d):
    slim = b.comments(spark, d).select("id", "post_id", "ordinal", "sentiment")
    return comments_sample(slim, 300, ["post_id", "ordinal"])


@query
def all_comments(spark, d):
    return comments_sample(b.comments(spark, d).select("id", "post_id", "ordinal", "sentiment"))


@query
def stats_by_quoted_name(spark, d):
    stats = kpis.group_stats(b.posts(spark, d), plain_names=False)
    sql = f"""
        SELECT subreddit, `avg(sentiment)` AS avg_sentiment, `avg(score)` AS avg_score,
               `{resolve_column(stats, "no_such_name", 2)}` AS by_position
        FROM {{stats}}
    """
    return run_sql(spark, sql, {"stats": stats})


@query
def adhoc_sql(spark, d):
    sql = """
        SELECT subreddit, count(*) AS n, max(score) AS best
        FROM {posts} WHERE sentiment < 0 GROUP BY subreddit
    """
    return run_sql(spark, sql, {"posts": b.posts(spark, d)})


# --- KPIs ------------------------------------------------------------------


@query
def group_stats(spark, d):
    return kpis.group_stats(b.with_comment_count(b.posts(spark, d), spark, d))


@query
def mean_sentiment_ranking(spark, d):
    return kpis.mean_ranking(kpis.group_stats(b.documents(spark, d)))


@query
def global_kpis(spark, d):
    return kpis.global_kpis(b.posts(spark, d), b.table(spark, d, "conversations"))


@query
def group_kpis(spark, d):
    return kpis.group_kpis(b.posts(spark, d))


@query
def sentiment_split(spark, d):
    return kpis.sentiment_split(b.documents(spark, d))


@query
def sentiment_split_per_group(spark, d):
    return kpis.sentiment_split(b.documents(spark, d), "subreddit")


@query
def distinct_groups(spark, d):
    return kpis.distinct_groups(b.documents(spark, d))


# --- trends ----------------------------------------------------------------


@query
def hourly_volume(spark, d):
    return trends.hourly_volume(b.table(spark, d, "events"), "ts", ["event_type"])


@query
def hourly_volume_of_group(spark, d):
    events = b.table(spark, d, "events").filter(in_groups("click", "event_type"))
    return trends.hourly_volume(events, "ts")


@query
def hourly_mean(spark, d):
    return trends.hourly_mean(b.table(spark, d, "events"), "ts", "value", ["event_type"])


@query
def hour_of_day(spark, d):
    return trends.hour_of_day_profile(b.table(spark, d, "events"), "ts", "value", ["event_type"])


@query
def daily_volume(spark, d):
    return trends.daily_volume(b.posts(spark, d), "created_utc")


@query
def daily_matrix(spark, d):
    return trends.daily_volume_matrix(b.table(spark, d, "events"), "ts", "event_type")


@query
def daily_matrix_of_two(spark, d):
    """All groups that are not named count as other."""
    events = b.table(spark, d, "events")
    return trends.daily_volume_matrix(events, "ts", "event_type", ["click", "view"])


@query
def daily_pages(spark, d):
    """The matrix over all communities, a few to a page."""
    pages = trends.daily_volume_pages(b.posts(spark, d), "created_utc", groups_per_page=7)
    said = F.array_join(F.transform("n", lambda n: n.cast("string")), ",")
    return pages.select("page", "day", F.array_join("groups", ",").alias("groups"), said.alias("n"))


# --- distributions ---------------------------------------------------------


@query
def box_minmax(spark, d):
    return distributions.box_stats(b.table(spark, d, "events"), "value", ["event_type"])


@query
def box_tukey(spark, d):
    events = b.table(spark, d, "events")
    return distributions.box_stats(events, "value", ["event_type"], whisker="tukey")


@query
def box_outliers(spark, d):
    return distributions.box_outliers(b.table(spark, d, "events"), "value", ["event_type"], store=True)


@query
def deciles(spark, d):
    """All eleven, over all events and by way of small sketches."""
    found = distributions.quantiles(b.table(spark, d, "events"), "value", [], [i / 10 for i in range(11)], k=64)
    return found.select("total", F.posexplode("q").alias("decile", "value"))


@query
def sentiment_boxes(spark, d):
    return distributions.box_stats(b.documents(spark, d), store=True)


CUTTING = {"lots": 64, "per_range": 100}


@query
def box_minmax_in_ranges(spark, d):
    """Small ranges, so that small tables take many of them as well."""
    return distributions.box_stats(_gappy(spark, d), "value", ["event_type"], **CUTTING)


@query
def box_tukey_in_ranges(spark, d):
    return distributions.box_stats(_gappy(spark, d), "value", ["event_type"], "tukey", **CUTTING)


def _gappy(spark, d):
    """Every seventh value is missing."""
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return b.table(spark, d, "events").withColumn("value", value)


@query
def histogram20_with_gaps(spark, d):
    return distributions.histogram(_gappy(spark, d), "value", by=["event_type"])


@query
def histogram20(spark, d):
    return distributions.histogram(b.table(spark, d, "events"), "value")


@query
def histogram20_per_group(spark, d):
    return distributions.histogram(b.table(spark, d, "events"), "value", by=["event_type"])


@query
def binned_scatter(spark, d):
    return distributions.binned_scatter(b.posts(spark, d))


# --- keywords and lexicon --------------------------------------------------


@query
def keywords_top20(spark, d):
    return keywords.top_keywords(b.documents(spark, d), 20)


@query
def keywords_per_group(spark, d):
    return keywords.top_keywords(b.documents(spark, d), 15, by="subreddit")


@query
def keywords_user_stopwords(spark, d):
    unwanted = spark.createDataFrame([(w,) for w in USER_STOPWORDS], "word string")
    docs = b.documents(spark, d)
    return keywords.top_keywords(docs, 20, by="subreddit", stopwords=unwanted)


@query
def lexicon_scores(spark, d):
    return lexicon_sentiment(b.documents(spark, d), LEXICON).select("id", "sentiment")


@query
def pandas_scores(spark, d):
    """A user's scorer as a pandas UDF.

    ``text.str`` ties a batch to itself in a cycle: all batches of a task would
    stay in memory until Python's collector happens to run.
    """

    @F.pandas_udf("double")
    def lines(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t.count("\n") / 100.0, na_action="ignore")

    raw = b.table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    return with_sentiment(with_clean_text(raw), lines).select("id", "sentiment")


# --- rankings --------------------------------------------------------------


@query
def top_posts(spark, d):
    return ranking.top_posts(b.with_comment_count(b.posts(spark, d), spark, d))


@query
def top_posts_per_group(spark, d):
    return ranking.top_posts_per_group(b.posts(spark, d))


@query
def top_authors(spark, d):
    return ranking.top_authors(b.metadata(spark, d))


@query
def top_authors_per_group(spark, d):
    return ranking.top_authors(b.posts(spark, d), by="subreddit")


@query
def latest_posts(spark, d):
    slim = b.posts(spark, d).select("id", "title", "subreddit", "created_utc")
    return ranking.latest_n_per_group(slim, 20)


@query
def first_comments(spark, d):
    slim = b.comments(spark, d).select("id", "post_id", "author", "ordinal")
    return ranking.first_k_per_parent(slim, 5)


# --- unions and copies -----------------------------------------------------


@query
def combined_landings(spark, d):
    """Posts landed by language, put together again."""
    docs = b.table(spark, d, "documents").select("doc_id", "lang", "source")
    parts = [docs.filter(F.col("lang") == code) for code in ("en", "fr", "de", "es")]
    rest = docs.filter(~F.coalesce(F.col("lang").isin("en", "fr", "de", "es"), F.lit(False)))
    return combine_landings(*parts, rest)


@query
def appended_runs(spark, d):
    """Two loads of the same posts accumulate."""
    store = FolderStore(spark, fresh_path(spark, "appended"))
    slim = b.metadata(spark, d).select("id", "score")
    store.append(slim, "posts", "first")
    store.append(slim, "posts", "second")
    return store.read("posts").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))


@query
def deduped_posts(spark, d):
    slim = b.posts(spark, d).select("id", "subreddit", "score", F.lit(1).alias("load"))
    later = slim.withColumn("score", F.col("score") + 1).withColumn("load", F.lit(2))
    both = combine_landings(slim, later)
    return ranking.dedupe_by_id(both, latest=[F.desc("load")]).drop("load")


# --- comments --------------------------------------------------------------


@query
def cohort_comments(spark, d):
    own = b.documents(spark, d).filter(in_groups("src1"))
    return cohorts.cohort_comments(own, b.comments(spark, d)).select("id", "post_id", "body", "sentiment")


@query
def comments_with_group(spark, d):
    slim = b.comments(spark, d).select("id", "post_id", "sentiment")
    return cohorts.with_group(slim, b.documents(spark, d))


@query
def comment_volume(spark, d):
    return cohorts.comment_volume(b.comments(spark, d), b.documents(spark, d))


@query
def comment_kpis(spark, d):
    return cohorts.comment_kpis(b.documents(spark, d), b.comments(spark, d))


def _colocated(spark, d):
    """Posts and comments as catalog tables, both laid out by post id."""
    path = fresh_path(spark, "colocated")
    name = f"murmura_{path[-32:]}"
    own = b.documents(spark, d).select("id", "subreddit")
    replies = b.comments(spark, d).drop("body", "clean_body")
    return (
        write_colocated(own, f"{name}_posts", "id", 8, f"{path}/posts"),
        write_colocated(replies, f"{name}_comments", "post_id", 8, f"{path}/comments"),
    )


@query
def colocated_comment_kpis(spark, d):
    return cohorts.comment_kpis(*_colocated(spark, d))


@query
def colocated_cohort(spark, d):
    own, replies = _colocated(spark, d)
    return cohorts.cohort_comments(own.filter(in_groups("src1")), replies).select("id", "post_id", "author", "score")


@query
def top_comments(spark, d):
    own = b.documents(spark, d).filter(in_groups("src1"))
    return cohorts.top_comments(own, b.comments(spark, d))


@query
def top_comments_per_group(spark, d):
    return cohorts.top_comments_per_group(b.documents(spark, d), b.comments(spark, d), late=True)


# --- prompts ---------------------------------------------------------------


def _contexts(spark, d):
    return prompts.prompt_context(b.with_comment_count(b.posts(spark, d), spark, d))


@query
def prompt_context(spark, d):
    return _contexts(spark, d)


@query
def joint_prompt_context(spark, d):
    return prompts.joint_contexts(_contexts(spark, d), groups_per_page=8)


@query
def prompt_table(spark, d):
    return prompts.build_prompts(_contexts(spark, d), PROMPTS, PROMPT_ROLE)


@query
def prompts_of_questions(spark, d):
    """Free questions as a table: one per group, asked of that group alone."""
    asked = b.documents(spark, d).groupBy("subreddit").agg(F.min("id").alias("first"))
    questions = asked.select(
        "subreddit",
        F.lit("first").alias("name"),
        F.concat(F.lit("What became of post "), F.col("first").cast("string"), F.lit("?")).alias("text"),
    )
    return prompts.build_prompts(_contexts(spark, d), questions, PROMPT_ROLE)


@query
def transcripts(spark, d):
    messages = b.table(spark, d, "conversations")
    # Every eleventh message has lost its turn.
    lost = F.when(F.pmod(F.col("conv_id") * 8 + F.col("turn"), F.lit(11)) != 0, F.col("turn"))
    return prompts.render_transcripts(messages.withColumn("turn", lost), page_turns=3)


@query
def spread_transcripts(spark, d):
    """The same with turnless messages numbered by ranges."""
    messages = b.table(spark, d, "conversations")
    lost = F.when(F.pmod(F.col("conv_id") * 8 + F.col("turn"), F.lit(11)) != 0, F.col("turn"))
    return prompts.render_transcripts(messages.withColumn("turn", lost), page_turns=3, spread=True)


@query
def newest_by_runs(spark, d):
    """The newest posts per community after four runs, of which the last is repeated; oldest posts come last."""
    store = FolderStore(spark, fresh_path(spark, "newest"))
    listed = b.posts(spark, d).select("id", "subreddit", "title", "created_utc")
    runs = F.pmod(F.dayofyear("created_utc") * 7, F.lit(4))
    for number, run in enumerate((2, 3, 0, 1, 1)):
        newest.merge_latest(store, "newest", listed.filter(runs == run), min(number, 3), 6)
    return newest.read_latest(store, "newest", listed.schema)


# --- files, jobs, streams --------------------------------------------------


def _raw_posts(spark, d):
    counted = b.with_comment_count(b.posts(spark, d), spark, d)
    micros = F.unix_micros(F.col("created_utc").cast("timestamp"))
    seconds = (micros.cast("decimal(20,0)") / 1000000).cast("decimal(24,6)")
    return counted.select(
        "id",
        "title",
        "body",
        "score",
        "author",
        seconds.alias("created_utc"),
        "subreddit",
        F.concat(F.lit("https://example.org/"), F.col("id").cast("string")).alias("url"),
        "num_comments",
    )


@query
def posts_csv_roundtrip(spark, d):
    path = fresh_path(spark, "landing") + "/posts.csv"
    write_landing(_raw_posts(spark, d), path)
    return read_posts(spark, path)


def _raw_comments(spark, d):
    tagged = cohorts.with_group(b.comments(spark, d), b.documents(spark, d))
    return tagged.select(
        "id", "post_id", "body", "author", "score", F.lit("0").alias("created_utc"), "subreddit"
    )


@query
def comments_csv_roundtrip(spark, d):
    path = fresh_path(spark, "landing") + "/comments.csv"
    write_landing(_raw_comments(spark, d), path)
    return read_comments(spark, path).drop("created_utc")


@query
def batch_job(spark, d):
    """CSV landing to processed tables to statistics, end to end."""
    landing = fresh_path(spark, "landing")
    write_landing(_raw_posts(spark, d), f"{landing}/posts.csv")
    write_landing(_raw_comments(spark, d), f"{landing}/comments.csv")
    store = FolderStore(spark, fresh_path(spark, "tables"))
    run_job(spark, landing, store, b.scorer)
    replies = store.read("comments").groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_comments"))
    return store.read("stats").join(replies, "subreddit", "left")


@query
def cumulative_statistics(spark, d):
    """Two runs of the job, the second one repeated; its statistics cover all posts once."""
    store = FolderStore(spark, fresh_path(spark, "tables"))
    raw = _raw_posts(spark, d)
    for run, part in (("a", raw.filter("id % 3 = 0")), ("b", raw.filter("id % 3 != 0"))):
        landing = fresh_path(spark, "landing")
        write_landing(part, f"{landing}/posts.csv")
        for _ in range(1 if run == "a" else 2):
            run_job(spark, landing, store, b.scorer, run=run)
    return cumulative_stats(store)


@query
def stream_clean_posts(spark, d):
    """The batch transformation on arriving files."""
    schema = b.table(spark, d, "documents").schema
    arriving = landing_stream.stream_named_table(spark, d, schema, "documents.parquet")
    raw = arriving.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("body"),
        F.col("n_chars").cast("string").alias("score"),
        F.col("source").alias("num_comments"),
    )
    folder = fresh_path(spark, "stream")
    posts = process_posts(raw, b.scorer)
    landing_stream.catch_up(posts, f"{folder}/posts", f"{folder}/progress")
    return spark.read.schema(posts.schema).parquet(f"{folder}/posts").select("id", "clean_body", "sentiment", "score")


@query
def batch_job_lexicon(spark, d):
    """The job with the polarity scorer."""
    landing = fresh_path(spark, "landing")
    write_landing(_raw_posts(spark, d), f"{landing}/posts.csv")
    write_landing(_raw_comments(spark, d), f"{landing}/comments.csv")
    store = FolderStore(spark, fresh_path(spark, "tables"))
    run_job(spark, landing, store, lexicon_scorer(LEXICON))
    return store.read("stats")


@query
def landed_row_counts(spark, d):
    """What each write of a landing reports, against the rows that are read back."""
    folder = fresh_path(spark, "landing")
    counts = {
        "posts": write_landing(_raw_posts(spark, d), f"{folder}/posts.csv"),
        "comments": write_landing(_raw_comments(spark, d), f"{folder}/comments.csv"),
    }
    posts = read_posts(spark, f"{folder}/posts.csv").agg(F.count(F.lit(1)).alias("n_read"))
    comments = read_comments(spark, f"{folder}/comments.csv").agg(F.count(F.lit(1)).alias("n_read"))
    return (
        posts.withColumn("name", F.lit("posts"))
        .unionByName(comments.withColumn("name", F.lit("comments")))
        .withColumn("n_reported", F.when(F.col("name") == "posts", counts["posts"]).otherwise(counts["comments"]))
    )


@query
def landing_previews(spark, d):
    """How many rows a preview shows of what was landed, before and after a reset of the landing."""
    path = fresh_path(spark, "landing") + "/posts.csv"
    rows = _raw_posts(spark, d)
    write_landing(rows, path)
    shown = preview(read_posts(spark, path), 7).count()
    write_landing(rows.limit(0), path)
    left = preview(read_posts(spark, path), 7).count()
    return rows.agg(F.count(F.lit(1)).alias("n_posts")).select(
        "n_posts", F.lit(shown).cast("bigint").alias("shown"), F.lit(left).cast("bigint").alias("after_reset")
    )


@query
def job_errors_surface(spark, d):
    """A job that cannot be done raises, and leaves what was stored as it was."""
    landing = fresh_path(spark, "landing")
    write_landing(_raw_posts(spark, d), f"{landing}/posts.csv")
    store = FolderStore(spark, fresh_path(spark, "tables"))
    run_job(spark, landing, store, b.scorer, run="first")
    found = []
    for job in (
        lambda: run_job(spark, landing, store, b.scorer, run="no/run/name"),
        lambda: run_job(spark, f"{landing}/nowhere", store, b.scorer, run="second"),
    ):
        try:
            job()
            found.append("none")
        except Exception as error:
            found.append(type(error).__name__)
    posts = store.read("posts").agg(F.count(F.lit(1)).alias("n_posts"))
    return posts.select("n_posts", *[F.lit(name).alias(f"error_{i}") for i, name in enumerate(found)])


@query
def snapshot_of_groups(spark, d):
    """A snapshot keeps what it read while its source goes on."""
    store = FolderStore(spark, fresh_path(spark, "snapshot_source"))
    slim = b.documents(spark, d).select("id", "subreddit")
    store.append(slim, "posts", "first")
    snapshot = Snapshot(spark).refresh(held_posts=store.read("posts"))
    store.append(slim, "posts", "second")
    held = snapshot["held_posts"].groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_held"))
    now = store.read("posts").groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_now"))
    return held.join(now, "subreddit")


@query
def missing_and_reset_tables(spark, d):
    """Rows of a table that was never written, one that was, and the same after a reset."""
    store = FolderStore(spark, fresh_path(spark, "reset"))
    slim = b.metadata(spark, d).select("id", "score")
    absent = table_or_empty(spark, "murmura_never_written", POSTS).select(F.lit("missing").alias("name"))
    unread = store.read("posts", slim.schema).select(F.lit("unwritten").alias("name"))
    store.append(slim, "posts", "first")
    copy = fresh_path(spark, "before_reset")
    store.read("posts").write.parquet(copy)
    store.reset({"posts": slim.schema})
    before = spark.read.parquet(copy).select(F.lit("written").alias("name"))
    after = store.read("posts").select(F.lit("reset").alias("name"))
    rows = absent.unionByName(unread).unionByName(before).unionByName(after)
    names = ["missing", "unwritten", "written", "reset"]
    return rows.agg(*[F.count_if(F.col("name") == name).alias(name) for name in names])


@query
def statistics_of_nothing(spark, d):
    """Empty inputs: no row passes the filter, and still there are figures."""
    none = b.posts(spark, d).filter("id < 0")
    return kpis.global_kpis(none, b.table(spark, d, "conversations").filter("conv_id < -5"))


@query
def stream_hourly_volume(spark, d):
    """Partial counts per micro-batch, added up on reading: all hours, open ones too."""
    schema = b.table(spark, d, "events").schema
    arriving = landing_stream.stream_named_table(spark, d, schema, "events.parquet")
    folder = fresh_path(spark, "stream")
    store = FolderStore(spark, f"{folder}/tables")
    landing_stream.catch_up_runs(
        arriving,
        store,
        "hours",
        f"{folder}/progress",
        lambda batch: landing_stream.hourly_counts(batch, "ts", "event_type"),
    )
    return landing_stream.total_counts(store.read("hours"), "event_type")


@query
def stream_deduped(spark, d):
    """Every document arrives twice, the copies after all originals; copies go on reading."""
    docs = b.table(spark, d, "documents").select("doc_id", "source", "n_chars")
    schema = docs.withColumn("load", F.lit(0)).schema
    folder = fresh_path(spark, "stream")
    store = FolderStore(spark, f"{folder}/tables")
    for load in (1, 2):
        docs.withColumn("load", F.lit(load)).write.mode("append").parquet(f"{folder}/in")
        arriving = landing_stream.stream_table(spark, f"{folder}/in", schema)
        landing_stream.catch_up_runs(arriving, store, "docs", f"{folder}/progress")
    return ranking.dedupe_by_id(store.read("docs"), "doc_id", [F.desc("load")])
