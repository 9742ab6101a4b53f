"""The queries of this subpackage as SQL, written by other means than the operators."""

ORACLES: dict[str, str] = {}

ORACLES["op1_line_frequency"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents
), word AS (
    SELECT row_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs)
), windowed AS (
    SELECT row_id, i, count(*) OVER ahead AS held,
        string_agg(w, ' ') OVER ahead AS words
    FROM word WINDOW ahead AS (PARTITION BY row_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), repeated AS (
    SELECT row_id, i FROM (
        SELECT row_id, i, count(*) OVER (PARTITION BY row_id, words) AS n FROM windowed WHERE held = 8
    ) WHERE n > 1
), covered AS (
    SELECT row_id, sum(CASE WHEN gap IS NULL OR gap > 8 THEN 8 ELSE gap END) AS n
    FROM (SELECT row_id, lead(i) OVER (PARTITION BY row_id ORDER BY i) - i AS gap FROM repeated)
    GROUP BY row_id
), size AS (
    SELECT row_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM word GROUP BY row_id
), line AS (
    SELECT row_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs
), held AS (
    SELECT *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D0-9]+', ' ', 'g')) AS normal,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
    FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), copies AS (
    SELECT row_id, count(*) - count(DISTINCT line) AS n FROM held GROUP BY row_id
), frequent AS (
    SELECT source, normal FROM held GROUP BY source, normal HAVING count(DISTINCT text) > 20
), removed AS (
    SELECT row_id, sum(n) AS n FROM held JOIN frequent
        ON held.source IS NOT DISTINCT FROM frequent.source AND held.normal = frequent.normal
    GROUP BY row_id
), figures AS (
    SELECT doc_id, coalesce(size.n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(copies.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
        coalesce(removed.n, 0)::BIGINT AS n_removed
    FROM docs LEFT JOIN size USING (row_id) LEFT JOIN covered USING (row_id)
        LEFT JOIN copies USING (row_id) LEFT JOIN removed USING (row_id)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND 100 * (n_words - n_removed) >= 30 * n_words AS kept FROM judged
"""

ORACLES["op2_weighted_fair_queueing"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(concat('mix', coalesce(doc_id::VARCHAR, ''))) AS key
    FROM documents
), sources AS (
    SELECT source, source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)
), fill(source, source_size, w, full_up, round) AS (
    SELECT source, source_size, w, FALSE, 0 FROM sources
    UNION ALL
    SELECT source, source_size, w,
        full_up OR 3 * source_size * sum(CASE WHEN full_up THEN 0 ELSE w END) OVER ()
            <= w * (sum(source_size) OVER () - sum(CASE WHEN full_up THEN 3 * source_size ELSE 0 END) OVER ()),
        round + 1
    FROM fill WHERE round < (SELECT count(*) FROM sources)
), targets AS (
    SELECT source, source_size, CASE WHEN full_up THEN (3 * source_size)::DOUBLE
        ELSE w::DOUBLE * (sum(source_size) OVER () - sum(CASE WHEN full_up THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
            / sum(CASE WHEN full_up THEN 0 ELSE w END) OVER () END AS target
    FROM fill WHERE round = (SELECT count(*) FROM sources)
), queue AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS ahead
    FROM docs
)
SELECT doc_id, size, source_size, target,
    (greatest(0, least(size, floor(target)::BIGINT - ahead))
    + greatest(0, least(size, floor(target)::BIGINT - source_size - ahead))
    + greatest(0, least(size, floor(target)::BIGINT - 2 * source_size - ahead)))::BIGINT AS taken
FROM queue JOIN targets ON queue.source IS NOT DISTINCT FROM targets.source
"""

_ASSIGN = (
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

ORACLES["op3_blob_ledger"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), rule(place, kind, pattern, grp, least) AS (
    VALUES (0, 'assign', '{_ASSIGN}', 1, 6), (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]+', 0, 24),
        (3, 'private_key', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1), (4, 'code_host', 'gh[pousr]_[A-Za-z0-9]{{36,}}', 0, 1),
        (5, 'chat_bot', 'xox[abprs]-[A-Za-z0-9-]{{10,}}', 0, 1),
        (6, 'web_token', 'eyJ[A-Za-z0-9_-]{{8,}}\.eyJ[A-Za-z0-9_-]{{8,}}\.[A-Za-z0-9_-]{{8,}}', 0, 1),
        (7, 'map_key', 'AIza[A-Za-z0-9_-]{{35,}}', 0, 1)
), matched AS (
    SELECT row_id, 0 AS place, unnest(regexp_extract_all(text, '{_ASSIGN}')) AS m,
        unnest(regexp_extract_all(text, '{_ASSIGN}', 1)) AS v, unnest(string_split_regex(text, '{_ASSIGN}')[:-2]) AS gap,
        generate_subscripts(regexp_extract_all(text, '{_ASSIGN}'), 1) AS i
    FROM docs WHERE regexp_matches(text, '{_ASSIGN}')
    UNION ALL
    SELECT row_id, place, unnest(ms), unnest(ms), unnest(gaps[:-2]), generate_subscripts(ms, 1)
    FROM (
        {" UNION ALL ".join(
            f"SELECT row_id, {place} AS place, regexp_extract_all(text, '{p}') AS ms, "
            f"string_split_regex(text, '{p}') AS gaps FROM docs WHERE regexp_matches(text, '{p}')"
            for place, p in (
                (1, "AKIA[A-Z0-9]+"),
                (2, "[0-9a-f]+"),
                (3, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
                (4, "gh[pousr]_[A-Za-z0-9]{36,}"),
                (5, "xox[abprs]-[A-Za-z0-9-]{10,}"),
                (6, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
                (7, "AIza[A-Za-z0-9_-]{35,}"),
            )
        )}
    )
), placed AS (
    SELECT row_id, place, v,
        sum(length(gap) + length(m)) OVER (PARTITION BY row_id, place ORDER BY i) AS "end", length(m) AS size
    FROM matched
), span AS (
    SELECT row_id, placed.place, kind, "end" - size AS start, concat(kind, ':', "end" - size, ':', "end") AS said
    FROM placed JOIN rule USING (place) WHERE length(v) >= least
), joined AS (
    SELECT row_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
        count(*) FILTER (place = 2) AS n_hex, string_agg(said, ',' ORDER BY start, place) FILTER (place < 3) AS base,
        string_agg(said, ',' ORDER BY start, place) AS spans
    FROM span GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row_id)
"""

ORACLES["op5_prefix_targets"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
        (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), sized AS (
    SELECT *, length(role) + length(text) + length('<|im_start|>') + length('<|im_end|>') + 2
        + len(regexp_extract_all(role, '[\n\\]|<\|')) + len(regexp_extract_all(text, '\\|<\|')) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples
FROM sized GROUP BY conv_id
"""

ORACLES["op6_winnowing"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), item AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, len(ws) AS n, ws FROM (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
        FROM benchmark
    )
), piece AS (
    SELECT DISTINCT item, least(n, 13) AS size,
        unnest([array_to_string(ws[i : i + least(n, 13) - 1], ' ') FOR i IN range(1, n - least(n, 13) + 2)]) AS words
    FROM item WHERE n > 0
), size AS (
    SELECT DISTINCT size FROM piece
), spot AS (
    SELECT row_id, size, pos, array_to_string(ws[pos : pos + size - 1], ' ') AS words
    FROM (SELECT row_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS pos FROM doc, size)
), hit AS (
    SELECT row_id, item, pos, spot.size FROM spot JOIN piece ON spot.size = piece.size AND spot.words = piece.words
), word AS (
    SELECT row_id, count(DISTINCT place) AS n_hit
    FROM (SELECT row_id, unnest(range(pos, pos + size)) AS place FROM hit) GROUP BY row_id
), named AS (
    SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_id, item FROM hit) GROUP BY row_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN word USING (row_id) LEFT JOIN named USING (row_id)
"""

ORACLES["op9_fast_similarity_sketching"] = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), shingles AS (
    SELECT doc_id, list_distinct([array_to_string(ws[i : i + least(len(ws), 3) - 1], ' ')
        FOR i IN range(1, len(ws) - least(len(ws), 3) + 2)]) AS s
    FROM doc WHERE len(ws) > 0
), item AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS s FROM shingles
), link AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM item a JOIN item b ON a.s = b.s AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(node, root) AS (
    SELECT doc_id, doc_id FROM shingles
    UNION
    SELECT b, root FROM reach JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) ON node = a
        WHERE root < b
), least_root AS (
    SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT doc.doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, coalesce(root, doc.doc_id) AS component_id,
    coalesce(root, doc.doc_id) = doc.doc_id AS kept
FROM doc LEFT JOIN shingles USING (doc_id) LEFT JOIN least_root ON node = doc.doc_id
"""

_PLANTED_WORDS = r"""
bytes AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')] AS said
    FROM documents
), crc_table AS (
    SELECT list_transform(range(256), lambda k: list_reduce(range(8), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k::BIGINT)) AS t
), hashed AS (
    SELECT row_id, doc_id, ws, xor(list_reduce(said, lambda c, b:
        xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
    FROM bytes, crc_table
), cut AS (
    SELECT row_id, doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, h // 10 AS g FROM hashed
), shaped AS (
    SELECT *, CASE WHEN planted THEN g % n END AS a FROM cut
), words AS MATERIALIZED (
    SELECT row_id, doc_id, CASE WHEN planted THEN list_transform(range(n),
        lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE ws END AS ws
    FROM shaped
)"""

ORACLES["op12_frequency_splitting"] = rf"""
WITH {_PLANTED_WORDS}, five AS (
    SELECT row_id, len(ws) AS n, unnest(range(1, len(ws) - 3)) AS i,
        unnest([array_to_string(ws[k : k + 4], ' ') FOR k IN range(1, len(ws) - 3)]) AS said
    FROM words WHERE len(ws) > 5
), pair AS (
    SELECT x.row_id, x.i, y.i - x.i AS q FROM five x JOIN five y
        ON x.row_id = y.row_id AND x.said = y.said AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretch AS (
    SELECT row_id, q, min(i) - 1 AS start, count(*) + 4 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS island FROM pair)
    GROUP BY row_id, q, island
), long AS (
    SELECT * FROM stretch WHERE length >= greatest(6, 4 * q)
), run AS (
    SELECT row_id, start, length, q AS period FROM long l WHERE NOT EXISTS (
        SELECT 1 FROM long s WHERE s.row_id = l.row_id AND s.q < l.q AND s.start <= l.start
            AND s.start + s.length >= l.start + l.length)
), summary AS (
    SELECT row_id, count(*) AS n_runs,
        first(struct_pack(s := start, l := length, p := period) ORDER BY length / period DESC, start, period) AS best,
        string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS said
    FROM run GROUP BY row_id
), gone AS (
    SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS i FROM run
), word AS (
    SELECT row_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM words WHERE row_id IN (SELECT row_id FROM run)
), collapsed AS (
    SELECT row_id, string_agg(w, ' ' ORDER BY word.i) AS said FROM word ANTI JOIN gone USING (row_id, i) GROUP BY row_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
    1000 * best.l // best.p AS exponent_milli, sha256(coalesce(summary.said, '')) AS runs_sha256,
    sha256(coalesce(collapsed.said, array_to_string(ws, ' '))) AS collapsed_sha256
FROM words LEFT JOIN summary USING (row_id) LEFT JOIN collapsed USING (row_id)
"""

ORACLES["op13_contingency_tensor"] = r"""
WITH known AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), doc AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), flag AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
        'A': len(ws) < 100,
        'B': 100 * len(list_distinct(ws)) < 80 * len(ws),
        'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(doc_id > first_id, FALSE)} AS fails
    FROM doc LEFT JOIN known USING (doc_id)
), cell AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flag GROUP BY part, fails
), letter(x) AS (
    VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), step AS (
    SELECT filter_order, step, filter_order[step] AS x,
        list_transform(range(1, step), lambda i: filter_order[i]) AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), judged AS (
    SELECT part, filter_order, step, x, n, good, toxic, fails[x] AS failed,
        len(list_filter(earlier, lambda y: fails[y])) > 0 AS before,
        len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: fails[y])) AS n_failed
    FROM step, cell
), figures AS (
    SELECT part, filter_order, step, x,
        sum(CASE WHEN NOT failed AND NOT before THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN failed AND NOT before THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN failed AND before THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN failed AND n_failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN failed AND NOT before THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN failed AND NOT before THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM figures
"""
