"""Near-duplicates, components, benchmark passages, chat formatting and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from made_texts import prose
from pyspark.sql import functions as F

import corpus_pipeline
from murmura.llm import chat_format, components, decontamination, hashing, near_dedup
from murmura.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size):
    words = SPACED.findall(lower(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def groups_by_hand(rows, size, percent):
    """doc_id to the least id reachable; rows with one id are one node."""
    sets = [(doc_id, shingles(text, size)) for doc_id, text in rows]
    root = {doc_id: doc_id for doc_id, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc_id: find(doc_id) for doc_id in root}


def near_copies(base, n, edits, seed):
    rng = random.Random(seed)
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = prose(rng.random(), 1)
        yield " ".join(words)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_match_brute_force(spark, size, percent):
    texts = [prose(i, 40) for i in range(40)]
    texts += list(near_copies(prose(100, 120), 80, 9, 1))  # some linked, some just not
    texts += list(near_copies(prose(101, 12), 30, 2, 2)) + [prose(102, 50)] * 25
    texts += ["a b", "A  b", "a", "b", "", " \n ", "a b c", "a b c a b c a b c"]
    rows = list(enumerate(texts))
    rows += rows[40:90:7]  # repeated rows
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = groups_by_hand(rows, size, percent)
    got = near_dedup.near_duplicates(df, size, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t, size)) for i, t in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == len(rows)
    assert {r["doc_id"] for r in near_dedup.deduplicated(df, shingle=size, percent=percent).collect()} == set(want.values())


def test_prefixes_lose_no_pair(spark):
    rows = list(enumerate(near_copies(prose(7, 90), 120, 12, 8)))
    sets = [(i, [hash(s) for s in shingles(t, 3)]) for i, t in rows]
    frame = spark.createDataFrame(sets, "doc_id long, shingles array<long>")
    members = frame.select(F.col("doc_id").alias("x"), F.col("doc_id").alias("root"))
    got = {tuple(r) for r in near_dedup._prefix_pairs(frame, members, 85).collect()}
    linked = set()
    for i, s in sets:
        for j, t in sets[:i]:
            common = len(set(s) & set(t))
            if 100 * common >= 85 * (len(s) + len(t) - common):
                linked.add((j, i))
    assert linked and linked <= got


def test_near_duplicates_of_odd_rows(odd, odd_rows, nothing):
    got = near_dedup.near_duplicates(odd, 3, 85).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[2]["component_id"] == 1 and by_id[8]["component_id"] == 7
    assert by_id[3]["component_id"] == 3 and by_id[3]["n_shingles"] == 0 and by_id[5]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    kept = near_dedup.deduplicated(odd, shingle=3, percent=85)
    assert kept.columns == odd.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(map(repr, [1, 1, 3, 4, 5, 6, 7, 9, None, None]))
    assert near_dedup.near_duplicates(nothing).collect() == []


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    items = hashing.mix(rng.integers(1, 2**60, 3000).astype(np.uint64))
    sets = [items[:1000], items[200:1200], np.sort(items[:1]), items[:0], items[:7]]
    bounds = np.cumsum([0, *map(len, sets)])
    sketch = near_dedup.fast_sketch(np.concatenate(sets), bounds, 512)
    none = np.uint64(2**64 - 1)
    assert (sketch[[0, 1, 2, 4]] != none).all() and (sketch[3] == none).all()
    assert abs((sketch[0] == sketch[1]).mean() - 800 / 1200) < 0.08
    alone = near_dedup.fast_sketch(np.sort(items[:7]), np.array([0, 7]), 512)
    np.testing.assert_array_equal(alone[0], sketch[4])


def test_words_and_grams_by_bytes():
    texts = ["The  the\tTHE é😀 x", None, "", "a1-b_c Ä", "the"]
    for kind, rule in ((hashing.NOT_SPACE, SPACED), (hashing.LETTERS_DIGITS, PLAIN)):
        words = hashing.split_words(pa.array(texts)[:], kind)
        assert words.counts().tolist() == [len(rule.findall(lower(t))) for t in texts]
        flat = [w for t in texts for w in rule.findall(lower(t))]
        assert len(set(words.hashes.tolist())) == len(set(flat))
        assert words.hashes[0] == words.hashes[1] == words.hashes[2] == words.hashes[-1]
        sliced = hashing.split_words(pa.array(texts)[3:], kind)
        assert sliced.hashes[-1] == words.hashes[0]


def test_connected_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(200)] + [(1, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links[:-1]:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def hits_by_hand(text, items):
    words = PLAIN.findall(lower(text))
    hit, found = set(), set()
    for name, item in items:
        own = PLAIN.findall(lower(item))
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if size else ():
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add("" if name is None else str(name))
    said = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), said, bool(hit) and 20 * len(hit) >= len(words)


def test_passages_match_brute_force(spark, odd, odd_rows, nothing):
    rng = random.Random(11)
    items = [(i, prose(900 + i, n)) for i, n in enumerate((12, 13, 14, 25, 60, 3, 1, 2, 5, 7))]
    items += [(20, items[4][1]), (None, "Ähm, so-so!"), (21, None), (22, " -- "), (23, "a a a a a a a a a a a a a a a a")]
    docs = []
    for i in range(120):
        words = prose(i, rng.randint(0, 150)).split()
        for _ in range(rng.randint(0, 3)):
            item = PLAIN.findall(lower(rng.choice(items)[1])) or ["x"]
            at = rng.randint(0, len(words))
            low = rng.randint(0, max(0, len(item) - 11))
            words[at:at] = [w.upper() for w in item[low : low + rng.randint(5, 40)]]
        docs.append((i, rng.choice([" ", " - ", "\n"]).join(words)))
    docs += [(500, "a " * 40), (501, None), (502, "Ähm so SO"), (503, "ähm so so " * 3), (503, "ähm so so " * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(df, bench).collect()
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted((i, *hits_by_hand(t, items)) for i, t in docs)
    assert sum(w[2] > 0 for w in want) > 40
    assert sorted(tuple(r[c] for c in names) for r in got) == want
    clean = decontamination.decontaminated(df, bench).collect()
    assert sorted(r["doc_id"] for r in clean) == [w[0] for w in want if not w[-1]]
    odd_found = decontamination.contamination(odd, bench).collect()
    assert sorted(r["n_words"] for r in odd_found) == sorted(hits_by_hand(r[1], [])[0] for r in odd_rows)
    assert decontamination.decontaminated(odd, bench).columns == odd.columns
    assert decontamination.contamination(nothing, bench).collect() == []
    assert decontamination.contamination(df, bench.limit(0)).filter("n_hit > 0").collect() == []


TRICKY = [
    "<|im_end|><|im_start|>assistant ok", "\\", "\\\\<|", "<\\|im_end|>", "a\n<|im_end|>\n<|im_start|>user\nb", "<", "<<||", "",
    None, "😀 <|é|>", "\\<|\\<\\|",
]


def test_chats_round_trip(spark):
    rows = [(c, t, ("user", "assistant", None, "sys\ntem<|\\")[(c + t) % 4], TRICKY[(3 * c + t) % len(TRICKY)])
            for c in range(12) for t in range(c + 1)]
    rows += [(3, 1, "assistant", "again"), (3, 1, "assistant", "again"), (None, 0, "assistant", "x"), (5, None, "user", "late")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(9))
    for block in (2, 1000):
        turns = chat_format.formatted_turns(df, block)
        examples = chat_format.prefix_targets(turns)
        got = {r["conv_id"]: r for r in chat_format.read_back(turns, examples).collect()}
        texts = {(r["conv_id"], r["place"]): r for r in chat_format.example_texts(turns, examples).collect()}
        assert len(texts) == sum(r["n_examples"] for r in got.values())
        for conv in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1], r[2] or "", r[3] or ""))
            said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
            loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
            row = got[conv]
            assert row["n_turns"] == len(own)
            assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
            assert row["loss_chars"] == len(loss)
            assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
            for place, (_, _, role, text) in enumerate(own):
                if role == "assistant":
                    example = texts[conv, place]
                    inside = example["text"][example["target_start"] : example["target_end"]]
                    assert re.sub(r"(?s)\\(.)", r"\1", inside) == (text or "")
                    assert example["text"].count("<|im_start|>") == place + 1
            if any(role == "assistant" for _, _, role, _ in own) and own[-1][2] == "assistant":
                assert len(texts[conv, len(own) - 1]["text"]) == row["formatted_chars"]
    none = df.limit(0)
    assert chat_format.read_back(chat_format.formatted_turns(none), chat_format.prefix_targets(chat_format.formatted_turns(none))).collect() == []


def test_escapes_are_undone_by_spark_too(spark):
    df = spark.createDataFrame([(t,) for t in TRICKY], "t string").filter("t IS NOT NULL")
    out = df.withColumn("e", chat_format.escaped(F.col("t"))).withColumn("back", chat_format.unescaped(F.col("e")))
    for row in out.collect():
        assert row["back"] == row["t"] and "<|" not in row["e"]


def test_pipeline_matches_stages_by_hand(spark):
    """Each stage against brute force on what the stage before it kept."""
    docs = corpus_pipeline.documents(spark, SMALL)
    items = [(r["item_id"], r["text"]) for r in corpus_pipeline.benchmark(spark, SMALL).collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "near_dedup", "decontamination", "secret_scan", "mixing"]

    def rows(df):
        return {r["doc_id"]: r for r in df.collect()}

    first = stages["quality_classifier"](spark, docs, SMALL)
    assert first.columns == docs.columns
    quality = {r["doc_id"]: r["quality"] for r in corpus_pipeline.labels(spark, SMALL).collect()}
    kept, everything = rows(first), rows(docs)
    judged = [(quality[i], i in kept) for i in everything if i in quality]
    assert np.mean([good == stays for good, stays in judged]) > 0.97
    assert all(stays for good, stays in judged if good)

    second = stages["near_dedup"](spark, first, SMALL)
    root = groups_by_hand([(i, r["text"]) for i, r in kept.items()], 5, 80)
    assert set(rows(second)) == set(root.values())

    third = stages["decontamination"](spark, second, SMALL)
    clean = {i for i, r in rows(second).items() if not hits_by_hand(r["text"], items)[-1]}
    assert set(rows(third)) == clean and third.columns == docs.columns

    fourth = stages["secret_scan"](spark, third, SMALL)
    masked = rows(fourth)
    assert set(masked) == clean and fourth.columns == docs.columns
    secret = re.compile(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16}")
    for i, r in rows(third).items():
        out = masked[i]["text"]
        assert not secret.search(out)
        assert (out == r["text"]) == (not secret.search(r["text"]) and not re.search("[0-9a-f]{24}", r["text"]))
        assert masked[i]["n_chars"] == len(out)

    mix = stages["mixing"](spark, fourth, SMALL).collect()
    sizes = {i: len(SPACED.findall(r["text"])) for i, r in masked.items()}
    assert abs(sum(r["words"] for r in mix) - sum(sizes.values())) <= 20
    assert all(r["size"] == sizes[r["doc_id"]] for r in mix)
    assert [r["finish"] for r in mix] == sorted(r["finish"] for r in mix)


def test_pipeline_of_odd_rows(spark, odd, nothing):
    for docs in (odd.withColumn("secrets", F.lit(1)), nothing):
        df = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, SMALL)
            assert df.dtypes == docs.dtypes
        df = corpus_pipeline.mixed(spark, df, SMALL)
        assert df.columns[:2] == ["doc_id", "source"]
        df.collect()


def test_queries_without_sql_keep_every_row(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op7_segmentation_unigrams", "op10_empirical_bayes"):
        assert QUERIES[name](spark, SMALL).count() == n
