"""Personal data, language identification, page text and document quality."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from made_texts import prose
from pyspark.sql import functions as F

from murmura.llm import html_text, language_id, pii, quality_classifier
from murmura.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

RULES = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes_luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")),
        "card": 13 <= len(digits) <= 19 and passes_luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def base_by_hand(text):
    return [
        (kind, *m.span()) for kind, rule in RULES.items() for m in rule.finditer(text or "") if valid(kind, m.group())
    ]


PERSONAL = [
    "a@b.c_d@e.f @x.y z@@q.r.s a@b a@b.c@d.e.f. mail: joe.doe+x@mail.example.com!",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 0010.0.0.1 1.2.3 999.1.2.3.4.5 00000000255.1.1.1",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111 12 4111  1111 1111 1111",
    "+1 (555) 010-2030 +12 345 +1 (555) 010-203040506070 ++4912345678 +1.2.3.4.5.6.7.8.9. 😀 +44 20 7946 0958",
    "😀é a@b.cd 10.0.0.1 +4912345678901 4111111111111111",
    None,
    "",
    "1" * 5000 + "." + "2" * 5000,
    ". ".join(f"x{i}@mail{i}.example.com" for i in range(300)),
]


def test_base_spans_match_the_rules(spark, odd, odd_rows):
    df = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id long, text string")
    for row in pii.personal_data(df).collect():
        found = [tuple(s) for s in row["spans"] if s["kind"] in pii.BASE]
        assert found == base_by_hand(PERSONAL[row["doc_id"]])
        assert [s["kind"] for s in row["spans"][len(found) :]] == ["other"] * (len(row["spans"]) - len(found))
    assert pii.personal_data(odd).count() == len(odd_rows)


@pytest.mark.parametrize("seed", range(40))
def test_base_spans_of_random_strings(seed):
    rng = np.random.default_rng(seed)
    text = "".join(rng.choice(list("ab1290@.+- ()%_é"), 400))
    assert pii.base_spans(text) == base_by_hand(text)


def test_trees_choose_further_spans(spark):
    """Phone numbers after a hint are like those with a plus; digits in hashes are not."""
    rng = np.random.default_rng(4)

    def number():
        a, b, c = rng.integers(200, 999), rng.integers(100, 999), rng.integers(1000, 9999)
        return f"({a}) {b}-{c}"

    rows = [(i, f"{prose(i, 5)} call +1 {number()} {prose(i + 1, 4)}") for i in range(150)]
    rows += [(200 + i, f"{prose(i, 5)} build key={rng.integers(10**9, 10**10)}x {prose(i, 3)}") for i in range(150)]
    rows += [(400 + i, f"{prose(i, 5)} version {rng.integers(10**6, 10**7)} {prose(i, 3)}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(df).collect()}
    assert all(any(s["kind"] == "phone" for s in got[i]) for i in range(150))
    assert not any(s["kind"] == "other" for i in range(200, 420) if i in got for s in got[i])


def test_trees_choose_hinted_forms_beyond_the_base_rules(spark):
    """Learnt from base spans in disguise; each loose form is found, plain numbers are not."""
    rng = np.random.default_rng(5)

    def digits(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def card():
        body = "4" + digits(14)
        return next(body + d for d in "0123456789" if passes_luhn(body + d))

    rows = []
    for i in range(150):
        phone = f"call +1 (2{digits(2)}) 555-{digits(4)}"
        mail = f"write to {prose(i, 1).strip('.')}{i}@mail{i % 9}.example.com"
        ip = f"server {rng.integers(1, 255)}.{rng.integers(0, 255)}.{rng.integers(0, 255)}.{rng.integers(1, 255)}"
        for j, said in enumerate([phone, mail, ip, f"card {card()}", f"build {digits(16)}", f"the {digits(9)} of"]):
            rows.append((10 * i + j, f"{prose(i + j, 12)} {said} {prose(i + j + 1, 4)}"))
    loose = {
        9001: ("please call ", "(415) 555-2671"),
        9002: ("write to ", "joe (at) example.com"),
        9003: ("host ", "00:1a:2b:3c:4d:5e"),
        9004: ("write to ", "ann.lee[at]mail.example.org"),
        9005: ("phone ", "415-555-2671"),
        9006: ("my card ", "4111.1111.1111.1111"),
    }
    rows += [(i, f"{prose(i, 12)} {hint}{span} {prose(i + 1, 4)}") for i, (hint, span) in loose.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    got = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "other"] for r in pii.personal_data(df).collect()}
    for i, (_, span) in loose.items():
        assert [texts[i][s["start"] : s["end"]] for s in got[i]] == [span]
    plain = [i for i in texts if i < 9000 and i % 10 in (4, 5)]
    assert sum(bool(got[i]) for i in plain) <= 0.05 * len(plain)


def labelled(spark, n):
    """Labelled numbers of ``n`` texts, of few different features."""
    rows = spark.range(n).selectExpr(
        "id AS doc_id", "xxhash64(id) AS version", "'number' AS form", "CAST(id % 2 AS int) AS label", "0L AS start",
        "9L AS `end`", "transform(sequence(0, 19), i -> CAST(id % 14 + i AS double)) AS features",
    )
    return rows.unionByName(rows.filter("label = 0").limit(7).withColumn("label", F.lit(None).cast("int")))


def test_trees_and_thresholds_come_from_all_labelled_candidates(spark, monkeypatch):
    seen = []

    def model(fit, made=pii._model):
        scored = made(fit)

        def counted(df):
            if "weight" in df.columns:
                seen.append([d.agg(F.sum("weight")).first()[0] for d in (fit, df)])
            return scored(df)

        return counted

    monkeypatch.setattr(pii, "_model", model)
    df = labelled(spark, 24_000)
    chosen = pii.chosen(df)
    assert sum(total or 0 for pair in seen for total in pair) == 24_000
    assert all(total is None or total > 11_000 for pair in seen for total in pair)
    assert chosen.count() == 0  # what has no label is like those of label 0


def test_weights_count_like_repeated_examples(spark):
    rows = labelled(spark, 3_000).filter("label IS NOT NULL").selectExpr(
        "CAST(IF(doc_id % 5 = 0, 1 - label, label) AS double) AS label", "features"
    )
    alike = rows.groupBy("label", "features").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    each = rows.withColumn("weight", F.lit(1.0))
    one = {r["features"][0]: r["score"] for r in pii._model(alike)(alike).select("features", "score").collect()}
    other = {r["features"][0]: r["score"] for r in pii._model(each)(each).select("features", "score").collect()}
    assert one == pytest.approx(other) and len(set(one.values())) > 1


def test_disguised_spans_are_proposed_and_not_base():
    base = ["joe@mail.example.com", "10.0.0.1", "4111 1111 1111 1111", "+1 (415) 555-2671", "+4930123456"]
    for span in base:
        ((kind, *place),) = pii.base_spans(span)
        assert place == [0, len(span)]
        assert [c["label"] for c in pii.candidates_of(f"x {span} y", pii.base_spans(f"x {span} y"))] == [1]
        assert kind not in [k for k, _, _ in pii.base_spans(pii.disguised(kind, span))]


def test_query_of_personal_data(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op4_candidate_boosting"](spark, SMALL).collect()
    assert len(got) == len(docs)
    for row in got:
        base = base_by_hand(docs[row["doc_id"]])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(b[0] == k for b in base) for k in pii.BASE]
        assert row["spans"].startswith(said)


def cuts(word):
    """All ways to cut a word."""
    for gaps in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, gap in enumerate(gaps, 1):
            if gap:
                parts.append(word[at:i])
                at = i
        yield [*parts, word[at:]]


@pytest.fixture(scope="module")
def trie():
    return language_id.pieces(language_id.VOCABULARY)


def node_of(trie, piece):
    """By walking, a character at a time."""
    codes = np.array([[trie.code.get(c, 0) for c in piece]], np.int32)
    for end, rows, nodes in trie.edges(codes, 0):
        if end == len(piece) and len(rows):
            return int(nodes[0])
    return None


@pytest.mark.parametrize("word", ["the", "tion", "naïve", "strasse", "\U00016a0aab", "aaaa"])
def test_forward_sums_over_all_segmentations(trie, word):
    rng = np.random.default_rng(3)
    chances = np.where(trie.is_piece[:, None], rng.random((trie.size, 2)), 0.0)
    want = np.zeros(2)
    for parts in cuts(language_id._START + word):
        nodes = [node_of(trie, part) for part in parts]
        if None not in nodes:
            want += np.prod([chances[node] for node in nodes], axis=0)
    got = language_id.forward(trie, [word], chances)[word]
    np.testing.assert_allclose(got, np.log(want), rtol=1e-9)
    uses = language_id.expected_pieces(trie, [word], np.array([2]), chances[:, 0])
    brute = np.zeros(trie.size)
    for parts in cuts(language_id._START + word):
        nodes = [node_of(trie, part) for part in parts]
        if None not in nodes:
            for node in nodes:
                brute[node] += 2 * np.prod([chances[n, 0] for n in nodes]) / want[0]
    np.testing.assert_allclose(uses, brute, atol=1e-9)


def test_long_words_do_not_underflow(trie):
    chances = language_id._chances(trie, np.zeros((trie.size, 2)))
    word = "zq" * 2000
    short = language_id.forward(trie, ["zq" * 10], chances)["zq" * 10]
    logs = language_id.forward(trie, [word], chances)[word]
    assert np.isfinite(logs).all() and (logs < 100 * short).all()


def test_long_words_count_in_training(trie):
    """A word of equal parts uses pieces in proportion to its length, however long or improbable it is."""
    chance = language_id._chances(trie, np.zeros((trie.size, 1)))[:, 0]
    short = language_id.expected_pieces(trie, ["zq" * 30], np.array([1]), chance)
    for times in (40, 2000):
        uses = language_id.expected_pieces(trie, ["zq" * times, "zq"], np.array([3, 0]), chance)
        assert np.isfinite(uses).all()
        np.testing.assert_allclose(uses.sum() / 3 / times, short.sum() / 30, rtol=0.1)


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_segmentation_unigrams"](spark, sf)
    joined = got.join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    held = joined.filter("held_out")
    assert 200 < held.count() < 300
    assert held.filter("lang = lang_pred").count() / held.count() > 0.99
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_languages_of_odd_rows(spark, odd, odd_rows, nothing):
    got = language_id.language_id(odd).collect()
    assert len(got) == len(odd_rows)
    for row in got:
        texts = {r[1] for r in odd_rows if r[0] == row["doc_id"]}
        if all(not t or not re.search(r"[^\W\d_]", t) for t in texts):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert language_id.language_id(nothing).collect() == []
    alone = spark.createDataFrame([(1, "hello", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.language_id(alone).collect()] == ["und"]


PAGES = {
    "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a>Home</a><li><a>Us</a></ul></nav>"
    "<article><h1>Head &amp; line</h1><p>First para<b>graph</b> of the\n   text,<br>it goes on.<p>Second&nbsp;one."
    "<script>if (a < b) x('</p>')</script></article><aside>More to read</aside><footer>&copy; me</footer>": (
        "Head & line\n\nFirst paragraph of the text, it goes on.\n\nSecond one."
    ),
    "<body><div id='wrap'><div class='cookie-notice'>We use cookies to make this long text better for you and us."
    "</div><main><p>Short.</p></main><section class='comments'><article class='comment'><p>I disagree with all of"
    " this, at length, in many more words than the text itself has.</p></article></section></div>": "Short.",
    "<p class='ad'>Buy<p>Plain text without any container at all, which is long enough to be seen as such.": (
        "Plain text without any container at all, which is long enough to be seen as such."
    ),
    "<div><a>one</a> <a>two</a> <a>three</a></div><div><p>A long paragraph about one thing and another, with many "
    "words in a row.</p><p>And yet another one, just as long as the first, to make it a region.</p><p>End.</p></div>"
    "<form><label>Name</label><input></form>": (
        "A long paragraph about one thing and another, with many words in a row.\n\nAnd yet another one, just as "
        "long as the first, to make it a region.\n\nEnd."
    ),
    "<article><p>cut &amp": "cut &",
    "<article><p>cut <b class='x": "cut",
    "just text": "just text",
    "<nav>only a menu</nav>": "",
    "": "",
    None: "",
}


def test_page_texts(spark):
    rows = [(i, None if i % 2 else f"http://h/{i}", html) for i, html in enumerate(PAGES)]
    df = spark.createDataFrame(rows + rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = html_text.extract_pages(df).collect()
    assert len(got) == 2 * len(rows)
    want = {row[0]: PAGES[row[2]] for row in rows}
    for row in got:
        assert row["text"] == want[row["page_id"]]
        assert row["n_chars"] == len(row["text"])
    assert html_text.extract_pages(df.limit(0)).collect() == []


def test_long_and_deep_pages():
    words = prose(5, 40000)
    assert html_text.main_text(f"<article><p>{words}</p></article>") == words
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert html_text.main_text(deep) == "deep"


def test_ratios_are_smoothed_and_cut():
    values = np.array([0.0, 0, 100, 100, 5, 100, 0, 0])
    smooth = html_text.smoothed(values)
    assert smooth[4] > 50 and smooth[0] < 10
    cut = html_text.threshold(smooth)
    assert 10 < cut < 90 and (smooth[2:6] > cut).all()
    assert html_text.threshold(np.array([5.0, 6.0])) == -1.0


def test_page_texts_of_the_table(spark):
    """Every page of the table has one article; the blocks in it are what is left, by another parse."""
    import html as entities

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for row in QUERIES["op8_text_to_tag_ratio"](spark, SMALL).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", pages[row["page_id"]], re.S).group(1)
        inside = re.sub(r"<[A-Za-z/!][^<>]*\Z", "", inside).replace("<br>", " ")
        inside = re.sub(r"</?[bi]>", "", inside)
        blocks = [" ".join(entities.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert row["text"] == "\n\n".join(b for b in blocks if b)


def junk(seed, n):
    return " ".join(f"{word.upper()}!!" for word in prose(seed, n).split())


def quality_table(spark):
    rows = [(i, prose(i, 20 + i % 50), "big" if i % 3 else f"h{i % 5}", "en") for i in range(200)]
    rows += [(1000 + i, junk(i, 20 + i % 50), "big" if i % 3 else "spam", "de") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    known = [(r[0], int(r[0] < 1000)) for r in rows if r[0] % 2]
    return docs, spark.createDataFrame(known, "doc_id long, label int")


def test_quality_of_unlabelled_documents(spark):
    docs, labels = quality_table(spark)
    got = quality_classifier.quality(docs, labels).collect()
    assert len(got) == 400
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in got)
    again = quality_classifier.quality(docs.repartition(7), labels).collect()
    assert {r["doc_id"]: round(r["quality"], 6) for r in got} == {r["doc_id"]: round(r["quality"], 6) for r in again}


def test_posteriors_match_a_plain_computation(spark):
    docs, labels = quality_table(spark)
    got = quality_classifier.quality(docs, labels).toPandas()
    table = got.merge(docs.toPandas(), on="doc_id")
    p, mean = table["evidence"], table["evidence"].mean()

    def strength(groups, prior):
        n, m = groups.size(), groups["evidence"].mean()
        spread = (n * ((m - prior) ** 2 - prior * (1 - prior) / n)).sum() / n.sum()
        return min(1000, max(1, (n * prior * (1 - prior)).sum() / n.sum() / spread - 1)) if spread > 0 else 1000

    hosts = table.groupby("source")
    k = strength(hosts, hosts["evidence"].mean() * 0 + mean)
    n_host, sum_host = table["source"].map(hosts.size()), table["source"].map(hosts["evidence"].sum())
    host = (sum_host - p + k * mean) / (n_host - 1 + k)
    np.testing.assert_allclose(table["host_quality"], host, rtol=1e-6)
    paths = table.groupby(["source", "lang"])
    prior = (hosts["evidence"].sum() + k * mean) / (hosts.size() + k)
    j = strength(paths, prior.reindex(paths.size().index.get_level_values(0)).set_axis(paths.size().index))
    size = paths["evidence"].transform("size")
    path = (paths["evidence"].transform("sum") - p + j * host) / (size - 1 + j)
    np.testing.assert_allclose(table["path_quality"], path, rtol=1e-6)
    odds = p / (1 - p) * path / (1 - path) / (mean / (1 - mean))
    np.testing.assert_allclose(table["quality"], odds / (1 + odds), rtol=1e-6)


def test_quality_of_odd_rows_and_labels(spark, odd, odd_rows, nothing):
    none = spark.createDataFrame([], "doc_id long, label int")
    one = spark.createDataFrame([(1, 1), (None, 0), (7, None), (99, 0)], "doc_id long, label int")
    two = spark.createDataFrame([(1, 1), (4, 0), (6, 0), (7, 1)], "doc_id long, label int")
    for labels in (none, one, two):
        got = quality_classifier.quality(odd, labels)
        assert got.count() == len(odd_rows)
        assert got.filter("quality IS NULL OR isnan(quality)").count() == 0
        kept = quality_classifier.good_documents(odd, labels)
        assert kept.columns == odd.columns and kept.count() == got.filter("kept").count()
    assert quality_classifier.quality(nothing, two).collect() == []
