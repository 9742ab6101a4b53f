"""The same results in plain SQL over the same tables."""

from __future__ import annotations

from acceptance.queries import LEXICON, PROMPT_ROLE, PROMPTS, USER_STOPWORDS
from murmura.functions import STOPWORDS
from murmura.functions.text import WHITESPACE

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _clean(text: str) -> str:
    return f"trim(lower(coalesce({text}, '')), {_BLANKS})"


def _sentiment(text: str) -> str:
    return (
        f"CASE WHEN contains(lower({text}), 'with') THEN 0.5::DOUBLE "
        f"WHEN contains(lower({text}), 'that') THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END"
    )


DOCS = f"""docs AS (
    SELECT doc_id AS id, concat_ws(' ', source, doc_id) AS title, text AS body, source AS subreddit,
           {_clean("text")} AS clean_body, {_sentiment("text")} AS sentiment
    FROM documents)"""

POSTS = f"""{DOCS}, posts AS (
    SELECT docs.*, e.value AS score, e.user_id AS author, e.ts AS created_utc,
           coalesce(c.n, 0) AS num_comments
    FROM docs JOIN events e ON e.event_id = docs.id
    LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) c
      ON c.conv_id = docs.id)"""

COMMENTS = f"""comments AS (
    SELECT conv_id || '-' || turn AS id, conv_id AS post_id, text AS body, role AS author,
           length(text)::DOUBLE AS score, turn AS ordinal,
           {_clean("text")} AS clean_body, {_sentiment("text")} AS sentiment
    FROM conversations)"""


def _share(side: str) -> str:
    total = "(count(*) FILTER (sentiment > 0) + count(*) FILTER (sentiment < 0) + count(*) FILTER (sentiment = 0))"
    return f"round(round(count(*) FILTER (sentiment {side}) * 100.0::DOUBLE / {total}, 9), 6)"


_SPLIT = f"""
    count(*) FILTER (sentiment > 0) AS positive, count(*) FILTER (sentiment < 0) AS negative,
    count(*) FILTER (sentiment = 0) AS neutral, {_share("> 0")} AS positive_pct,
    {_share("< 0")} AS negative_pct, {_share("= 0")} AS neutral_pct"""

_QUARTILES = """
    quantile_cont({0}, 0.25) AS q1, quantile_cont({0}, 0.5) AS median, quantile_cont({0}, 0.75) AS q3"""


def _boxes(source: str, by: str, value: str) -> str:
    return f"""
    SELECT {by}, count({value}) AS n, round(round(min({value}), 9), 6) AS whisker_low,
           round(round(quantile_cont({value}, 0.25), 9), 6) AS q1,
           round(round(quantile_cont({value}, 0.5), 9), 6) AS median,
           round(round(quantile_cont({value}, 0.75), 9), 6) AS q3, round(round(max({value}), 9), 6) AS whisker_high
    FROM {source} GROUP BY {by}"""


_FENCES = f"""box AS (
    SELECT event_type, {_QUARTILES.format("value")} FROM events GROUP BY event_type),
fenced AS (
    SELECT e.event_type, e.value, q1, median, q3,
           q1 - 1.5 * (q3 - q1) AS fence_low, q3 + 1.5 * (q3 - q1) AS fence_high
    FROM events e JOIN box USING (event_type))"""


def _bin(x: str, lo: str, hi: str, bins: int = 20) -> str:
    start = f"(CASE WHEN {lo} = {hi} THEN {lo} - 0.5 ELSE {lo} END)"
    width = f"(CASE WHEN {lo} = {hi} THEN 1.0::DOUBLE ELSE {hi} - {lo} END)"
    return f"least(floor(({x} - {start}) / {width} * {bins}), {bins - 1})::INTEGER"


def _words(text: str, source: str, min_length: int, stopwords, columns: str) -> str:
    """Words of a text as rows; the token lists come first, then they are unnested."""
    return f"""lists AS MATERIALIZED (
    SELECT {columns}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM {source}),
words AS (
    SELECT {columns}, w AS word FROM (SELECT {columns}, unnest(ws) AS w FROM lists)
    WHERE length(w) >= {min_length} AND w NOT IN ({_quoted(stopwords)}))"""


_TITLED = "concat_ws(' ', source, doc_id) || ' ' || text"


def _csv(name: str) -> str:
    text = f"coalesce({name}::VARCHAR, '')"
    return (
        f"CASE WHEN regexp_matches({text}, '[\",\\r\\n]') "
        f"THEN '\"' || replace({text}, '\"', '\"\"') || '\"' ELSE {text} END"
    )


_CONTEXT_COLUMNS = ["title", "body", "subreddit", "score", "num_comments"]
_CONTEXTS = f"""{POSTS}, ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id))::INTEGER AS rank
    FROM posts),
lines AS (
    SELECT subreddit, rank, {" || ',' || ".join(_csv(c) for c in _CONTEXT_COLUMNS)} AS line
    FROM ranked WHERE rank <= 15),
contexts AS (
    SELECT subreddit, count(*) AS n_rows, '{",".join(_CONTEXT_COLUMNS)}' || chr(10)
           || string_agg(line, chr(10) ORDER BY rank) AS context
    FROM lines GROUP BY subreddit)"""

_LATIN1 = "regexp_replace({}, '[^\\x{{0}}-\\x{{FF}}]', '?', 'g')"

_LEXICON = ", ".join(f"('{w}', {p}::DOUBLE)" for w, p in LEXICON.items())

_INSTRUCTIONS = " UNION ALL ".join(
    f"SELECT '{k}' AS instruction, '{v}' AS text" for k, v in PROMPTS.items()
)

ORACLES: dict[str, str] = {
    # projections
    "clean_posts": f"WITH {DOCS} SELECT id, clean_body, sentiment FROM docs",
    "processed_comments": f"""WITH {COMMENTS}
        SELECT id, post_id, body, score, clean_body, sentiment FROM comments""",
    "lenient_casts": """
        SELECT event_id,
               CASE WHEN event_type IN ('click', 'purchase') THEN k::DOUBLE END AS as_double,
               CASE WHEN event_type = 'click' THEN k END AS as_int_strict,
               CASE WHEN event_type IN ('click', 'purchase') THEN k END AS as_int_lenient
        FROM (SELECT event_id, event_type, regexp_extract(props, '(\\d+)', 1)::INTEGER AS k FROM events)""",
    "post_dates": """
        SELECT event_id, ts AS date, hour(ts)::INTEGER AS hour, ts::DATE AS day FROM events""",
    "post_texts": f"SELECT doc_id AS id, {_clean(_TITLED)} AS text FROM documents",
    "report_titles": f"""
        SELECT doc_id AS id, CASE WHEN length(text) > 75
            THEN substring({_LATIN1.format("text")}, 1, 75) || '...'
            ELSE {_LATIN1.format("text")} END AS title
        FROM documents""",
    "scatter_rows": f"WITH {POSTS} SELECT title, subreddit, score, sentiment FROM posts",
    # filters, loads, ad-hoc SQL
    "posts_of_groups": f"""WITH {POSTS}
        SELECT id, title, score FROM posts WHERE subreddit IN ('src1', 'src2', 'src3')""",
    "preview_of_processed_posts": f"""WITH {POSTS}
        SELECT title, clean_body, sentiment, score FROM posts ORDER BY id LIMIT 5""",
    "sample_of_comments": f"""WITH {COMMENTS}
        SELECT id, post_id, ordinal, sentiment FROM comments ORDER BY post_id, ordinal LIMIT 300""",
    "all_comments": f"WITH {COMMENTS} SELECT id, post_id, ordinal, sentiment FROM comments",
    "stats_by_quoted_name": f"""WITH {POSTS}
        SELECT subreddit, round(round(avg(sentiment), 9), 6) AS avg_sentiment,
               round(round(avg(score), 9), 6) AS avg_score, round(round(avg(sentiment), 9), 6) AS by_position
        FROM posts GROUP BY subreddit""",
    "adhoc_sql": f"""WITH {POSTS}
        SELECT subreddit, count(*) AS n, max(score) AS best
        FROM posts WHERE sentiment < 0 GROUP BY subreddit""",
    # KPIs
    "group_stats": f"""WITH {POSTS}
        SELECT subreddit, round(round(avg(score), 9), 6) AS avg_score, round(round(avg(sentiment), 9), 6) AS avg_sentiment,
               round(round(avg(num_comments), 9), 6) AS avg_num_comments
        FROM posts GROUP BY subreddit""",
    "mean_sentiment_ranking": f"""WITH {DOCS}
        SELECT subreddit, round(round(avg(sentiment), 9), 6) AS avg_sentiment FROM docs GROUP BY subreddit""",
    "global_kpis": f"""WITH {POSTS}
        SELECT count(*) AS n_posts, round(round(avg(score), 9), 6) AS avg_score,
               round(round(avg(sentiment), 9), 6) AS avg_sentiment,
               (SELECT count(*) FROM conversations) AS n_comments
        FROM posts""",
    "group_kpis": f"""WITH {POSTS}
        SELECT subreddit, count(*) AS n_posts, max(score) AS max_score,
               round(round(avg(sentiment), 9), 6) AS avg_sentiment,
               round(round(avg(CASE WHEN sentiment > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 9), 6) AS positive_pct
        FROM posts GROUP BY subreddit""",
    "sentiment_split": f"WITH {DOCS} SELECT {_SPLIT} FROM docs",
    "sentiment_split_per_group": f"""WITH {DOCS}
        SELECT subreddit, {_SPLIT} FROM docs GROUP BY subreddit""",
    "distinct_groups": "SELECT DISTINCT source AS subreddit FROM documents",
    # trends
    "hourly_volume": """
        SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS n
        FROM events GROUP BY ALL""",
    "hourly_volume_of_group": """
        SELECT date_trunc('hour', ts) AS hour_start, count(*) AS n
        FROM events WHERE event_type = 'click' GROUP BY ALL""",
    "hourly_mean": """
        SELECT date_trunc('hour', ts) AS hour_start, event_type, round(round(avg(value), 9), 6) AS avg_value
        FROM events GROUP BY ALL""",
    "hour_of_day": """
        SELECT event_type, hour(ts)::INTEGER AS hour_of_day, count(*) AS n,
               round(round(avg(value), 9), 6) AS avg_value
        FROM events GROUP BY ALL""",
    "daily_volume": f"""WITH {POSTS}
        SELECT created_utc::DATE AS day, subreddit, count(*) AS n FROM posts GROUP BY ALL""",
    "daily_matrix": f"""
        SELECT ts::DATE AS day,
               {", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in EVENT_TYPES)}
        FROM events GROUP BY ALL""",
    "daily_matrix_of_two": """
        SELECT ts::DATE AS day, count(*) FILTER (event_type = 'click') AS click,
               count(*) FILTER (event_type = 'view') AS view,
               count(*) FILTER (event_type NOT IN ('click', 'view')) AS other
        FROM events WHERE event_type IS NOT NULL GROUP BY ALL""",
    # distributions
    "box_minmax": _boxes("events", "event_type", "value"),
    "box_tukey": f"""WITH {_FENCES}
        SELECT event_type, count(value) AS n,
               round(round(least(min(value) FILTER (value >= fence_low), any_value(q1)), 9), 6) AS whisker_low,
               round(round(any_value(q1), 9), 6) AS q1, round(round(any_value(median), 9), 6) AS median,
               round(round(any_value(q3), 9), 6) AS q3,
               round(round(greatest(max(value) FILTER (value <= fence_high), any_value(q3)), 9), 6) AS whisker_high,
               count(*) FILTER (value < fence_low OR value > fence_high) AS n_outliers
        FROM fenced GROUP BY event_type""",
    "box_outliers": f"""WITH {_FENCES}
        SELECT event_type, value, count(*) AS n FROM fenced
        WHERE value < fence_low OR value > fence_high GROUP BY event_type, value""",
    "sentiment_boxes": f"WITH {DOCS} {_boxes('docs', 'subreddit', 'sentiment')}",
    "histogram20": f"""
        WITH span AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
        cells AS (SELECT {_bin("value", "lo", "hi")} AS bin, count(*) AS n FROM events, span GROUP BY ALL)
        SELECT b.bin::INTEGER AS bin, round(round(lo + (hi - lo) / 20 * b.bin, 9), 6) AS bin_low,
               round(round(lo + (hi - lo) / 20 * (b.bin + 1), 9), 6) AS bin_high, coalesce(cells.n, 0) AS n
        FROM range(20) AS b(bin) CROSS JOIN span LEFT JOIN cells ON cells.bin = b.bin""",
    "histogram20_per_group": f"""
        WITH span AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type),
        cells AS (
            SELECT event_type, {_bin("value", "lo", "hi")} AS bin, count(*) AS n
            FROM events JOIN span USING (event_type) GROUP BY ALL)
        SELECT span.event_type, b.bin::INTEGER AS bin, round(round(lo + (hi - lo) / 20 * b.bin, 9), 6) AS bin_low,
               round(round(lo + (hi - lo) / 20 * (b.bin + 1), 9), 6) AS bin_high, coalesce(cells.n, 0) AS n
        FROM range(20) AS b(bin) CROSS JOIN span
        LEFT JOIN cells ON cells.bin = b.bin AND cells.event_type = span.event_type""",
    "binned_scatter": f"""WITH {POSTS}, span AS (
            SELECT min(sentiment) AS xl, max(sentiment) AS xh, min(score) AS yl, max(score) AS yh FROM posts)
        SELECT subreddit, {_bin("sentiment", "xl", "xh")} AS x_bin, {_bin("score", "yl", "yh")} AS y_bin,
               count(*) AS n
        FROM posts, span GROUP BY ALL""",
    # keywords and lexicon
    "keywords_top20": f"""WITH {_words(_TITLED, "documents", 4, sorted(STOPWORDS), "doc_id")}
        SELECT word, count(*) AS freq FROM words GROUP BY word ORDER BY freq DESC, word LIMIT 20""",
    "keywords_per_group": f"""WITH {_words(_TITLED, "documents", 4, sorted(STOPWORDS), "source")},
        counted AS (SELECT source AS subreddit, word, count(*) AS freq FROM words GROUP BY ALL)
        SELECT subreddit, word, freq,
               (row_number() OVER (PARTITION BY subreddit ORDER BY freq DESC, word))::INTEGER AS rank
        FROM counted QUALIFY rank <= 15""",
    "keywords_user_stopwords": f"""WITH {_words(_TITLED, "documents", 4, USER_STOPWORDS, "source")},
        counted AS (SELECT source AS subreddit, word, count(*) AS freq FROM words GROUP BY ALL)
        SELECT subreddit, word, freq,
               (row_number() OVER (PARTITION BY subreddit ORDER BY freq DESC, word))::INTEGER AS rank
        FROM counted QUALIFY rank <= 20""",
    "lexicon_scores": f"""
        WITH lists AS MATERIALIZED (
            SELECT doc_id AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM documents),
        words AS (SELECT id, unnest(ws) AS word FROM lists),
        lexicon(word, polarity) AS (VALUES {_LEXICON}),
        scored AS (SELECT id, avg(polarity) AS s FROM words JOIN lexicon USING (word) GROUP BY id)
        SELECT documents.doc_id AS id, round(round(coalesce(s, 0.0), 9), 6) AS sentiment
        FROM documents LEFT JOIN scored ON scored.id = documents.doc_id""",
    # rankings
    "top_posts": f"""WITH {POSTS}
        SELECT id, title, score, sentiment, num_comments FROM posts ORDER BY score DESC, id LIMIT 5""",
    "top_posts_per_group": f"""WITH {POSTS}
        SELECT subreddit, id, title, score, sentiment,
               (row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, id))::INTEGER AS rank
        FROM posts QUALIFY rank <= 5""",
    "top_authors": """
        SELECT user_id AS author, count(*) AS posts FROM events
        GROUP BY user_id ORDER BY posts DESC, author LIMIT 10""",
    "top_authors_per_group": f"""WITH {POSTS},
        activity AS (SELECT subreddit, author, count(*) AS posts FROM posts GROUP BY ALL)
        SELECT subreddit, author, posts,
               (row_number() OVER (PARTITION BY subreddit ORDER BY posts DESC, author))::INTEGER AS rank
        FROM activity QUALIFY rank <= 10""",
    "latest_posts": f"""WITH {POSTS}
        SELECT id, title, subreddit, created_utc,
               (row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id))::INTEGER AS rank
        FROM posts QUALIFY rank <= 20""",
    "first_comments": f"""WITH {COMMENTS}
        SELECT id, post_id, author, ordinal,
               (row_number() OVER (PARTITION BY post_id ORDER BY ordinal))::INTEGER AS rank
        FROM comments QUALIFY rank <= 5""",
    # unions and copies
    "combined_landings": "SELECT doc_id, lang, source FROM documents",
    "appended_runs": """
        SELECT event_id AS id, 2::BIGINT AS n, round(round(value + value, 9), 6) AS total FROM events""",
    "deduped_posts": f"""WITH {POSTS}
        SELECT id, subreddit, round(round(score + 1, 9), 6) AS score FROM posts""",
    # comments
    "cohort_comments": f"""WITH {COMMENTS}
        SELECT id, post_id, body, sentiment FROM comments
        WHERE post_id IN (SELECT doc_id FROM documents WHERE source = 'src1')""",
    "comments_with_group": f"""WITH {COMMENTS}
        SELECT c.id, c.post_id, c.sentiment, d.source AS subreddit
        FROM comments c LEFT JOIN documents d ON d.doc_id = c.post_id""",
    "comment_volume": """
        SELECT d.source AS subreddit, count(*) AS n
        FROM conversations c JOIN documents d ON d.doc_id = c.conv_id GROUP BY d.source""",
    "comment_kpis": f"""WITH {COMMENTS}
        SELECT d.source AS subreddit, count(*) AS n_comments,
               round(round(avg(c.sentiment), 9), 6) AS avg_comment_sentiment
        FROM comments c JOIN documents d ON d.doc_id = c.post_id GROUP BY d.source""",
    "top_comments": f"""WITH {COMMENTS}
        SELECT id, body, author, score, sentiment FROM comments
        WHERE post_id IN (SELECT doc_id FROM documents WHERE source = 'src1')
        ORDER BY score DESC, id LIMIT 10""",
    "top_comments_per_group": f"""WITH {COMMENTS}
        SELECT d.source AS subreddit, c.id, c.body, c.author, c.score, c.sentiment,
               (row_number() OVER (PARTITION BY d.source ORDER BY c.score DESC, c.id))::INTEGER AS rank
        FROM comments c JOIN documents d ON d.doc_id = c.post_id QUALIFY rank <= 10""",
    # prompts
    "prompt_context": f"WITH {_CONTEXTS} SELECT subreddit, n_rows, context FROM contexts",
    "joint_prompt_context": f"""WITH {_CONTEXTS}, placed AS (
            SELECT *, row_number() OVER (ORDER BY subreddit) - 1 AS p
            FROM (SELECT subreddit, n_rows, substring(context, strpos(context, chr(10)) + 1) AS rows FROM contexts))
        SELECT (p // 8)::BIGINT AS page, sum(n_rows)::BIGINT AS n_rows, '{",".join(_CONTEXT_COLUMNS)}' || chr(10)
               || string_agg(rows, chr(10) ORDER BY p) AS context
        FROM placed GROUP BY ALL""",
    "prompts_of_questions": f"""WITH {_CONTEXTS}, asks AS (
            SELECT source AS subreddit, 'What became of post ' || min(doc_id) || '?' AS text FROM documents GROUP BY source)
        SELECT subreddit, 'first' AS instruction,
               '{PROMPT_ROLE}' || chr(10) || chr(10) || 'Data (CSV):' || chr(10) || context
               || chr(10) || chr(10) || 'Instruction: ' || text AS prompt
        FROM contexts JOIN asks USING (subreddit)""",
    "prompt_table": f"""WITH {_CONTEXTS}, asks AS ({_INSTRUCTIONS})
        SELECT subreddit, instruction,
               '{PROMPT_ROLE}' || chr(10) || chr(10) || 'Data (CSV):' || chr(10) || context
               || chr(10) || chr(10) || 'Instruction: ' || text AS prompt
        FROM contexts CROSS JOIN asks""",
    "transcripts": f"""
        WITH said AS (
            SELECT conv_id, CASE WHEN (conv_id * 8 + turn) % 11 <> 0 THEN turn END AS turn,
                   CASE WHEN role = 'user' THEN 'User:' ELSE 'Assistant:' END
                   || chr(10) || {_LATIN1.format("text")} AS line FROM conversations),
        placed AS (
            SELECT conv_id, turn // 3 AS page, turn AS place, line FROM said WHERE turn IS NOT NULL
            UNION ALL
            SELECT conv_id, -((place + 2) // 3), place, line FROM (
                SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY line) AS place
                FROM said WHERE turn IS NULL))
        SELECT conv_id, page::BIGINT AS page, string_agg(line, chr(10) || chr(10) ORDER BY place) AS transcript
        FROM placed GROUP BY ALL""",
    # files, jobs, streams
    "posts_csv_roundtrip": f"""WITH {POSTS}
        SELECT id::VARCHAR AS id, title, body, score::VARCHAR AS score, author::VARCHAR AS author,
               (epoch_us(created_utc)::DECIMAL(24, 6) / 1000000)::DECIMAL(24, 6)::VARCHAR AS created_utc,
               subreddit, 'https://example.org/' || id AS url, num_comments::VARCHAR AS num_comments
        FROM posts""",
    "comments_csv_roundtrip": f"""WITH {COMMENTS}
        SELECT c.id, c.post_id::VARCHAR AS post_id, c.body, c.author, c.score::VARCHAR AS score,
               d.source AS subreddit
        FROM comments c LEFT JOIN documents d ON d.doc_id = c.post_id""",
    "batch_job": f"""WITH {POSTS},
        stats AS (
            SELECT subreddit, round(round(avg(score), 9), 6) AS avg_score,
                   round(round(avg(sentiment), 9), 6) AS avg_sentiment,
                   round(round(avg(num_comments), 9), 6) AS avg_num_comments
            FROM posts GROUP BY subreddit),
        replies AS (
            SELECT d.source AS subreddit, count(*) AS n_comments
            FROM conversations c JOIN documents d ON d.doc_id = c.conv_id GROUP BY d.source)
        SELECT * FROM stats LEFT JOIN replies USING (subreddit)""",
    "stream_clean_posts": f"""WITH {DOCS}
        SELECT id, clean_body, sentiment, length(body)::DOUBLE AS score FROM docs""",
    "stream_hourly_volume": """
        SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS n
        FROM events GROUP BY ALL""",
    "stream_deduped": "SELECT doc_id, source, n_chars, 2::INTEGER AS load FROM documents",
    "landed_row_counts": f"""WITH {POSTS}
        SELECT 'posts' AS name, count(*) AS n_read, count(*) AS n_reported FROM posts
        UNION ALL SELECT 'comments', count(*), count(*) FROM conversations""",
    "landing_previews": f"""WITH {POSTS}
        SELECT count(*) AS n_posts, least(count(*), 7)::BIGINT AS shown, 0::BIGINT AS after_reset FROM posts""",
    "job_errors_surface": f"""WITH {POSTS}
        SELECT count(*) AS n_posts, 'ValueError' AS error_0, 'AnalysisException' AS error_1 FROM posts""",
    "snapshot_of_groups": """
        SELECT source AS subreddit, count(*) AS n_held, 2 * count(*) AS n_now FROM documents GROUP BY source""",
    "missing_and_reset_tables": """
        SELECT 0::BIGINT AS missing, 0::BIGINT AS unwritten, count(*) AS written, 0::BIGINT AS reset FROM events""",
    "statistics_of_nothing": """
        SELECT count(*) AS n_posts, avg(value) AS avg_score, avg(value) AS avg_sentiment,
               0::BIGINT AS n_comments FROM events WHERE event_id < 0""",
    "pandas_scores": """
        SELECT doc_id AS id, round(round((length(trim(text, chr(10) || ' '))
               - length(replace(trim(text, chr(10) || ' '), chr(10), ''))) / 100, 9), 6) AS sentiment FROM documents""",
    "histogram20_with_gaps": f"""
        WITH kept AS (SELECT event_type, value FROM events WHERE event_id % 7 <> 0),
        span AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM kept GROUP BY event_type),
        cells AS (
            SELECT event_type, {_bin("value", "lo", "hi")} AS bin, count(*) AS n
            FROM kept JOIN span USING (event_type) GROUP BY ALL)
        SELECT span.event_type, b.bin::INTEGER AS bin, round(round(lo + (hi - lo) / 20 * b.bin, 9), 6) AS bin_low,
               round(round(lo + (hi - lo) / 20 * (b.bin + 1), 9), 6) AS bin_high, coalesce(cells.n, 0) AS n
        FROM range(20) AS b(bin) CROSS JOIN span
        LEFT JOIN cells ON cells.bin = b.bin AND cells.event_type = span.event_type""",
    "batch_job_lexicon": f"""WITH {POSTS},
        lists AS MATERIALIZED (
            SELECT id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM posts),
        words AS (SELECT id, unnest(ws) AS word FROM lists),
        lexicon(word, polarity) AS (VALUES {_LEXICON}),
        scored AS (SELECT id, avg(polarity) AS s FROM words JOIN lexicon USING (word) GROUP BY id)
        SELECT subreddit, round(round(avg(score), 9), 6) AS avg_score,
               round(round(avg(coalesce(s, 0.0)), 9), 6) AS avg_sentiment,
               round(round(avg(num_comments), 9), 6) AS avg_num_comments
        FROM posts LEFT JOIN scored USING (id) GROUP BY subreddit""",
}
ORACLES["box_minmax_in_ranges"] = _boxes("(SELECT * FROM events WHERE event_id % 7 <> 0)", "event_type", "value")
ORACLES["box_tukey_in_ranges"] = ORACLES["box_tukey"].replace(
    "FROM events", "FROM (SELECT * FROM events WHERE event_id % 7 <> 0)"
)
ORACLES["deciles"] = """
    WITH found AS (
        SELECT count(value) AS total, quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q
        FROM events)
    SELECT total, unnest(range(11))::INTEGER AS decile, round(round(unnest(q), 9), 6) AS value FROM found"""
ORACLES["colocated_comment_kpis"] = ORACLES["comment_kpis"]
ORACLES["colocated_cohort"] = f"""WITH {COMMENTS}
    SELECT id, post_id, author, score FROM comments
    WHERE post_id IN (SELECT doc_id FROM documents WHERE source = 'src1')"""
ORACLES["daily_pages"] = f"""WITH {POSTS}, daily AS (
        SELECT created_utc::DATE AS day, subreddit, count(*) AS n FROM posts WHERE subreddit IS NOT NULL GROUP BY ALL
    ), place AS (
        SELECT subreddit, (row_number() OVER (ORDER BY subreddit) - 1) // 7 AS page
        FROM (SELECT DISTINCT subreddit FROM daily)
    ), cell AS (
        SELECT page, day, subreddit FROM place, (SELECT DISTINCT day FROM daily)
    )
    SELECT page, day, string_agg(subreddit, ',' ORDER BY subreddit) AS groups,
        string_agg(coalesce(n, 0)::VARCHAR, ',' ORDER BY subreddit) AS n
    FROM cell LEFT JOIN daily USING (day, subreddit) GROUP BY page, day HAVING sum(n) > 0"""
ORACLES["cumulative_statistics"] = ORACLES["group_stats"]
ORACLES["newest_by_runs"] = f"""WITH {POSTS}
    SELECT id, subreddit, title, created_utc FROM (
        SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id) AS place
        FROM posts WHERE subreddit IS NOT NULL) WHERE place <= 6"""
ORACLES["spread_transcripts"] = ORACLES["transcripts"]
