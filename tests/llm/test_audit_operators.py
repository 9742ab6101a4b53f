"""Toxicity, periodic runs and the filter audit against brute force."""

import hashlib
import itertools
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from made_texts import prose
from pyspark.sql import functions as F

from murmura.llm import filter_audit, periodic_runs, toxicity
from murmura.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def runs_by_hand(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            inside = any(s <= i and s + m >= i + n for s, m, _ in found)
            if n >= max(6, 4 * q) and not inside:
                found.append((i, n, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_by_operator(texts):
    words, bounds = periodic_runs.split_words(pa.array(texts))
    owners, *columns = periodic_runs.runs_of(words.dictionary_encode().indices.to_numpy(zero_copy_only=False), bounds)
    found = [[] for _ in texts]
    for owner, *run in zip(owners, *columns):
        found[owner].append(tuple(map(int, run)))
    return found


def test_words_are_cut_at_low_white_space():
    texts = [" a\x0bb \x0c\tc\nd\re ", None, "", "\x1cx\x85y z w", "ends\n"]
    words, bounds = periodic_runs.split_words(pa.array(texts))
    assert words.to_pylist() == ["a", "b", "c", "d", "e", "\x1cx\x85y", "z w", "ends"]
    assert bounds.tolist() == [0, 5, 5, 5, 7, 8]


@pytest.mark.parametrize("seed", range(30))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        alphabet = LETTERS[: rng.choice([1, 2, 3, 5, 26])]
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, 90))]
        if words and rng.random() < 0.7:
            start, period = rng.randrange(len(words)), rng.randint(1, 12)
            words = [w if i < start else words[min(len(words) - 1, start + (i - start) % period)] for i, w in enumerate(words)]
        texts.append(" \t".join(words))
    assert runs_by_operator(texts) == [runs_by_hand(text.split()) for text in texts]


def test_nested_and_overlapping_runs():
    inner = "x x x x x x y".split() * 5
    fibonacci = ["a", "a b"]
    while len(fibonacci) < 12:
        fibonacci.append(fibonacci[-1] + " " + fibonacci[-2])
    for words in (inner, "a b a b a b a b a b b a b b a b b a b b".split(), fibonacci[-1].split()):
        assert runs_by_operator([" ".join(words)]) == [runs_by_hand(words)]
    assert (0, 35, 7) in runs_by_hand(inner)


def test_splitting_recurses():
    """Words that are frequent in a text but rare between two rare words split further."""
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 40, 4000)
    numbers[::25] = np.arange(1000, 1160)
    places, _ = periodic_runs.split_at_rare(np.arange(4000), numbers, 4, 6)
    assert len(places) < 100
    kept, _ = periodic_runs.split_at_rare(np.arange(12), np.tile([5, 6, 7], 4), 4, 6)
    assert len(kept) == 12


def test_runs_take_little_more_than_linear_time():
    def seconds(n, period):
        numbers = np.tile(np.arange(period), n // period + 1)[:n]
        began = time.perf_counter()
        owners, starts, lengths, periods = periodic_runs.runs_of(numbers, np.array([0, n]))
        assert (starts[0], lengths[0], periods[0]) == (0, n, period)
        return time.perf_counter() - began

    for period in (1, 1000):
        assert seconds(400_000, period) < 12 * seconds(100_000, period) + 1


def test_periodic_runs_of_odd_rows(spark, odd, odd_rows, nothing):
    found = periodic_runs.periodic_runs(odd)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = sorted(((r[0], [tuple(x) for x in r[1]], r[2]) for r in found.collect()), key=repr)
    want = []
    for id, text, *_ in odd_rows:
        words = (text or "").split()
        runs = runs_by_hand(words) if len(words) < 1000 else []
        want.append((id, runs, collapsed_by_hand(words, runs)))
    assert got == sorted(want, key=repr)
    assert periodic_runs.periodic_runs(nothing).count() == 0
    kept = periodic_runs.without_repeats(odd)
    assert kept.columns == odd.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, odd.collect()))


def test_collapsed_texts(spark):
    rows = [(1, "say a b a b a b a b end"), (2, "A a A a a A a A"), (3, "no  run\there"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(map(tuple, periodic_runs.without_repeats(df).collect())) == {
        1: "say a b end",
        2: "A a A a a A a A",
        3: "no  run\there",
        4: None,
    }


def test_query_of_runs_by_hand(spark):
    """The digest columns, over the texts with planted runs."""
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op12_frequency_splitting"](spark, SMALL).collect()}
    for id, text in texts:
        words, h = _ascii_words(text), zlib.crc32(str(id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 1200:
            continue
        runs = runs_by_hand(words)
        row = got[id]
        assert row["n_runs"] == len(runs)
        said = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed_by_hand(words, runs).encode()).hexdigest()
        if runs:
            start, length, period = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]))
            assert (row["start"], row["length"], row["period"]) == (start, length, period)
            assert row["exponent_milli"] == 1000 * length // period
        else:
            assert row["start"] is row["length"] is row["period"] is row["exponent_milli"] is None


def _ascii_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def audit_by_hand(rows, labels):
    """rows: (id, part, text); labels: id to (quality, toxic)."""
    failed = []
    for id, part, text in rows:
        text = text or ""
        words = _ascii_words(text)
        smaller = [i for i, _, t in rows if i is not None and id is not None and i < id and (t or "") == text]
        letters = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": bool(smaller),
        }
        failed.append((part or "", {x for x, bad in letters.items() if bad}, *labels.get(id, (0, 0))))
    table = {}
    for part in {row[0] for row in failed}:
        own = [row[1:] for row in failed if row[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if letter in row[0]]
                left = [row for row in left if letter not in row[0]]
                removed_by[letter] += len(gone)
                failing = sum(letter in row[0] for row in own)
                table[part, order, step] = [
                    len(left),
                    len(gone),
                    failing - len(gone),
                    sum(row[0] == {letter} for row in own),
                    sum(row[1] == 1 for row in gone),
                    sum(row[2] == 1 for row in gone),
                ]
        for (p, order, step), counts in table.items():
            if p == part:
                counts.append(removed_by[order[step - 1]])
    return sorted((*key, *counts) for key, counts in table.items())


def test_audit_matches_brute_force(spark, odd, odd_rows, nothing):
    rng = random.Random(5)
    rows = [tuple(row[:3]) for row in odd_rows if len(row[1] or "") < 5000]
    rows = [(id, lang, text) for id, text, lang in rows]
    for i in range(20, 120):
        words = [rng.choice(["Word", "w%d" % rng.randrange(400), "X"]) for _ in range(rng.choice([30, 99, 100, 300]))]
        text = " ".join(words) + rng.choice(["", "", " a|b", " #"])
        rows.append((i, rng.choice(["en", "de", None, ""]), text))
        if rng.random() < 0.3:
            rows.append((rng.choice([i + 500, i - 15]), "en", text))
    labels = {i: (rng.randrange(2), rng.randrange(2)) for i in range(0, 120, 2)}
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    df = df.withColumns({name: F.lit("clash") for name in ("id", "part", "same", "n", "A", "E", "first", "good", "quality")})
    known = [(i, q, t) for i, (q, t) in labels.items()] + [(None, 1, 1), (2, None, None), (9999, 1, 1)]
    known = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(df, known)
    assert sorted(map(tuple, got.collect())) == audit_by_hand(rows, labels)
    assert filter_audit.filter_audit(nothing, known).count() == 0
    assert filter_audit.filter_audit(odd, known.limit(0)).count() == 600 * 4


def test_contraction_of_one_cell():
    tensor = np.zeros((3, 2, 2, 2, 2, 2), np.int64)
    tensor[0, 1, 0, 1, 0, 0] = 7
    table = filter_audit.contracted(tensor).set_index(["filter_order", "step"])
    assert tuple(table.loc[("ABCDE", 1), ["kept", "removed", "redundant"]]) == (0, 7, 0)
    assert tuple(table.loc[("ABCDE", 3), ["kept", "removed", "redundant"]]) == (0, 0, 7)
    assert table.loc[("CABDE", 1), "shapley"] == 7 * 60
    assert (table["unique_fails"] == 0).all()


RUDE = ["grumbly", "snarkle"]


def made_comments(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * n + i, rng.randint(5, 60)).split()
        label = int(rng.random() < 0.3)
        if label:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((i, " ".join(words), label))
    return rows


def test_toxicity_learns_words_and_pairs(spark):
    rows = made_comments(600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows if i % 2], "doc_id long, label int")
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    right = sum(found[i]["predicted"] == label for i, _, label in rows if i % 2 == 0)
    assert right >= 290
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs.repartition(7), labels).collect()}
    assert all(abs(again[i] - found[i]["score"]) < 1e-9 for i in again)
    # Either word alone is in all texts; only together they tell.
    paired = [(i, prose(i, 20) + (" cold bell" if i % 3 else " bell then cold") + " " + prose(i + 9, 5)) for i in range(600)]
    docs = spark.createDataFrame(paired, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, label int")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    assert sum(found[i] == (i % 3 == 0) for i in range(400, 600)) >= 195


def test_ftrl_matches_a_plain_loop():
    rng = np.random.default_rng(2)
    docs = [np.unique(rng.integers(0, 30, 8)) for _ in range(80)]
    labels = np.array([int(3 in d) for d in docs])
    values = rng.random(80) + 0.5
    r = toxicity.Rates(alpha=0.5, l1=0.3, l2=0.1, epochs=3)
    z, n = [0.0] * 30, [0.0] * 30
    share = (labels.sum() + 1) / 82
    b, squares = float(np.log(share / (1 - share))), 0.0

    def weight(i):
        if abs(z[i]) <= r.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * r.l1) / ((r.beta + n[i] ** 0.5) / r.alpha + r.l2)

    for _ in range(r.epochs):
        for doc, value, label in zip(docs, values, labels):
            w = {i: weight(i) for i in doc}
            error = 1 / (1 + np.exp(-(b + value * sum(w.values())))) - label
            for i in doc:
                g = error * value
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / r.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
            squares += error * error
            b -= 0.1 * error / (1 + squares**0.5)
    weights, intercept = toxicity.follow(docs, values, labels, 30, r)
    assert np.allclose(weights, [weight(i) for i in range(30)])
    assert np.isclose(intercept, b)
    assert (weights == 0).any() and weights[3] > 0


def test_toxicity_of_odd_rows(spark, odd, odd_rows, nothing):
    labels = [(1, 1), (1, 0), (2, 0), (3, 1), (4, 0), (None, 1), (6, None), (77, 1), (8, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, label int")
    found = toxicity.toxicity(odd, labels).collect()
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(row[0]) for row in odd_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (3, 4, 5)}) == 1
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert toxicity.toxicity(nothing, labels).count() == 0
    for only in (labels.limit(0), labels.filter("label = 0")):
        assert len({r["score"] for r in toxicity.toxicity(odd, only).collect()}) == 1


def test_bounds_of_the_model(spark):
    rows = made_comments(300, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, label int")
    model = toxicity.fitted(docs, labels, max_labelled=100, max_words=2000, max_weights=5)
    assert 0 < len(model.keys) <= 5
    assert (np.diff(model.keys.astype(float)) > 0).all()


def test_held_out_toxicity_of_the_table(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    scored = [r for r in QUERIES["op11_ftrl_proximal"](spark, MIDDLE).collect() if r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    held = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in scored if r["held_out"]]
    bad = sorted(score for score, _, label in held if label)
    good = sorted(score for score, _, label in held if not label)
    assert sum(predicted for _, predicted, label in held if not label) <= 0.005 * len(good)
    assert sum(predicted for _, predicted, label in held if label) >= 0.65 * len(bad)
    ordered = np.searchsorted(good, bad).mean() / len(good)
    assert ordered > 0.95
