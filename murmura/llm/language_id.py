"""Language identification by unigram models, summed over all segmentations.

A word is cut into pieces of a fixed public vocabulary. Each language has its
own probability for every piece, and a word's probability is the sum over all
ways to cut it. A text's is the product over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.operators.ranking import top_k_per_group
from murmura.operators.skew import with_group_row
from murmura.sources.scratch import stage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
DOCS_PER_LANGUAGE = 1000
ROUNDS = 3
UNKNOWN = 1e-7
SMOOTHING = 0.5
CACHED_WORDS = 400_000
CELLS = 1 << 21
UNDETERMINED = "und"
_LOTS = 1 << 30

_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"


def word_counts(text: str | None) -> Counter:
    """Words of letters in lower case, each marked at its start."""
    return Counter(_LETTERS.findall(text.lower())) if text else Counter()


class Pieces:
    """The vocabulary's pieces of letters as a trie in arrays.

    Node 0 is dead and node 1 the root. ``first`` leads from the root by any
    character, ``steps`` from deeper nodes by characters that occur there.
    Every character counts as a piece; an unknown one is the single node 2.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        names = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
        names = {n for n in names if _LETTERS.fullmatch(n.removeprefix(_START) or "a")}
        self.longest = max(map(len, names), default=1)
        chars = sorted({c for name in names for c in name} | {_START})
        self.code = {c: i + 1 for i, c in enumerate(chars)}
        names = sorted(names | set(chars))
        children: list[dict[int, int]] = [{}, {}, {}]
        self.is_piece = [False, False, True]
        for name in names:
            node = 1
            for c in name:
                nxt = children[node].get(self.code[c])
                if nxt is None:
                    nxt = len(children)
                    children[node][self.code[c]] = nxt
                    children.append({})
                    self.is_piece.append(False)
                node = nxt
            self.is_piece[node] = True
        self.size = len(children)
        self.is_piece = np.array(self.is_piece)
        self.first = np.full(len(chars) + 1, 2, np.int32)
        for code, node in children[1].items():
            self.first[code] = node
        inner = [n for n in range(3, self.size) if children[n]]
        later = sorted({code for n in inner for code in children[n]})
        self.column = np.zeros(len(chars) + 1, np.int32)
        self.column[later] = np.arange(1, len(later) + 1)
        self.row = np.zeros(self.size, np.int32)
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.steps = np.zeros((len(inner) + 1, len(later) + 1), np.int32)
        for n in inner:
            for code, nxt in children[n].items():
                self.steps[self.row[n], self.column[code]] = nxt

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words, the start mark first, padded with -1; and lengths."""
        lengths = np.array([len(word) + 1 for word in words])
        out = np.full((len(words), lengths.max()), -1, np.int32)
        get = self.code.get
        for i, word in enumerate(words):
            out[i, 0] = self.code[_START]
            out[i, 1 : lengths[i]] = [get(c, 0) for c in word]
        return out, lengths

    def edges(self, codes: np.ndarray, begin: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Pieces that begin at a place: end, rows and nodes, for all words at once."""
        rows = np.flatnonzero(codes[:, begin] >= 0)
        nodes = self.first[codes[rows, begin]]
        end = begin + 1
        while len(rows):
            piece = self.is_piece[nodes]
            yield end, rows[piece], nodes[piece]
            if end == codes.shape[1] or end - begin == self.longest:
                return
            code = codes[rows, end]
            nodes = np.where(code >= 0, self.steps[self.row[nodes], self.column[np.maximum(code, 0)]], 0)
            alive = nodes > 0
            rows, nodes = rows[alive], nodes[alive]
            end += 1


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _blocks(words: list[str]) -> Iterator[list[str]]:
    """Words of similar length, as many as fit into a bounded array."""
    ordered = sorted(words, key=len)
    at = 0
    while at < len(ordered):
        stop = at + 1
        while stop < len(ordered) and (stop + 1 - at) * (len(ordered[stop]) + 1) <= CELLS // 8:
            stop += 1
        yield ordered[at:stop]
        at = stop


def forward(trie: Pieces, words: list[str], chances: np.ndarray) -> dict[str, np.ndarray]:
    """Log probability of each word in each language, over all segmentations.

    ``chances`` has a row per node and a column per language. Values are
    scaled up again before they become too small for a double.
    """
    out = {}
    for block in _blocks(words):
        codes, lengths = trie.codes(block)
        n, width = codes.shape
        alpha = np.zeros((width + 1, n, chances.shape[1]))
        alpha[0] = 1.0
        scale = np.zeros((n, chances.shape[1]))
        for begin in range(width):
            for end, rows, nodes in trie.edges(codes, begin):
                alpha[end, rows] += alpha[begin, rows] * chances[nodes]
            if begin % 4 == 3:
                ahead = alpha[begin + 1 : begin + 1 + trie.longest]
                small = (ahead.max(axis=0) < 1e-150) & (lengths[:, None] > begin)
                if small.any():
                    ahead *= np.where(small, 1e150, 1.0)
                    scale -= np.where(small, np.log(1e150), 0.0)
        last = alpha[lengths, np.arange(n)]
        logs = np.log(last) + scale
        out.update(zip(block, logs))
    return out


def expected_pieces(trie: Pieces, words: list[str], counts: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Expected number of uses of every node in the words of one language (forward and backward).

    Words of any length count: both passes are scaled up like ``forward``.
    """
    uses = np.zeros(trie.size)
    weight = dict(zip(words, counts))
    for block in _blocks(words):
        codes, lengths = trie.codes(block)
        n, width = codes.shape
        places = np.arange(n)
        alpha, beta = np.zeros((width + 1, n)), np.zeros((width + 1, n))
        alpha[0], beta[lengths, places] = 1.0, 1.0
        scales = np.zeros((width + 1, n))  # of alpha, place by place
        edges = [list(trie.edges(codes, begin)) for begin in range(width)]
        for begin in range(width):
            for end, rows, nodes in edges[begin]:
                alpha[end, rows] += alpha[begin, rows] * chance[nodes]
            ahead = alpha[begin + 1 : begin + 1 + trie.longest]
            scales[begin + 1] = scales[begin] + _scaled_up(ahead, begin % 4 == 3, lengths > begin)
        with np.errstate(divide="ignore"):
            logs = np.log(alpha) + scales
        total, scale = logs[lengths, places], np.zeros(n)
        times = np.array([weight[word] for word in block], float)
        times[~np.isfinite(total)], total[~np.isfinite(total)] = 0.0, 0.0
        for begin in range(width - 1, -1, -1):
            here = begin < lengths
            share = np.zeros(n)
            share[here] = times[here] * np.exp((logs[begin] + scale - total)[here])
            for end, rows, nodes in edges[begin]:
                part = beta[end, rows] * chance[nodes]
                beta[begin, rows] += part
                np.add.at(uses, nodes, part * share[rows])
            scale += _scaled_up(beta[begin : begin + trie.longest], begin % 4 == 3, here)
    return uses


def _scaled_up(values: np.ndarray, due: bool, alive: np.ndarray) -> np.ndarray | float:
    """Scales up in place the columns that have become small; the logarithm to add for that."""
    if not due:
        return 0.0
    small = (values.max(axis=0) < 1e-150) & alive
    if small.any():
        values *= np.where(small, 1e150, 1.0)
    return np.where(small, -np.log(1e150), 0.0)


def _chances(trie: Pieces, uses: np.ndarray) -> np.ndarray:
    """Smoothed probabilities; columns are languages."""
    known = trie.is_piece[:, None]
    total = np.where(known, uses + SMOOTHING, 0.0)
    total /= total.sum(axis=0)
    total[2] = UNKNOWN
    return np.where(known, np.maximum(total, UNKNOWN), 0.0)


def trained(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    rounds: int = ROUNDS,
) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities, learned from docs (doc_id, text, lang).

    From each language the ``docs_per_language`` documents with the least hash
    of the id are taken, so reruns agree. Each round of expectation
    maximisation spreads the words over the tasks and adds up expected uses;
    only these, a number per language and piece, come to the driver.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    slim = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("lot"))
    # Of a language with many documents all but about as many as are wanted go where they are read.
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    wanted = docs_per_language + 5 * docs_per_language**0.5
    share = F.pmod("lot", F.lit(_LOTS)) < F.floor(F.lit(_LOTS * wanted) / F.col("n")) + 1
    order = [F.pmod("lot", F.lit(_LOTS)), F.asc("doc_id")]
    few = with_group_row(slim, counts, ["lang"]).filter(share)
    ids = top_k_per_group(few, ["lang"], order, docs_per_language, parts=0)
    ids = stage(ids.select("doc_id", "lang"), "language_sample")
    texts = labelled.join(ids, ["doc_id", "lang"], "left_semi").select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                totals.setdefault(lang, Counter()).update(word_counts(text))
            for lang, words in totals.items():
                if words:
                    columns = [[lang] * len(words), list(words), list(words.values())]
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    counted = texts.mapInArrow(count, "lang string, word string, n long")
    words = stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language_words")
    langs = [row[0] for row in words.select("lang").distinct().orderBy("lang").collect()]
    trie = pieces(vocabulary)
    chances = _chances(trie, np.zeros((trie.size, max(1, len(langs)))))
    if not langs:
        return langs, chances
    column = {lang: i for i, lang in enumerate(langs)}
    uses_schema = pa.schema([("lang", pa.string()), ("node", pa.int32()), ("uses", pa.float64())])
    for _ in range(rounds):
        given = docs.sparkSession.sparkContext.broadcast(chances)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            local = pieces(vocabulary)
            for batch in batches:
                own = batch.to_pandas()
                for lang, rows in own.groupby("lang"):
                    chance = given.value[:, column[lang]]
                    uses = expected_pieces(local, list(rows["word"]), rows["n"].to_numpy(), chance)
                    nodes = np.flatnonzero(uses)
                    arrays = [pa.array([lang] * len(nodes)), pa.array(nodes.astype(np.int32)), pa.array(uses[nodes])]
                    yield pa.RecordBatch.from_arrays(arrays, schema=uses_schema)

        expected = words.repartition("word").mapInArrow(expect, "lang string, node int, uses double")
        sums = expected.groupBy("lang", "node").agg(F.sum("uses").alias("uses")).collect()
        uses = np.zeros((trie.size, len(langs)))
        for lang, node, value in sums:
            uses[node, column[lang]] = value
        chances = _chances(trie, uses)
        given.unpersist()
    return langs, chances


def predicted(
    docs: DataFrame, langs: list[str], chances: np.ndarray, vocabulary: str = VOCABULARY
) -> DataFrame:
    """doc_id, lang_pred and score of every row of docs (doc_id, text).

    The score is the posterior probability of the best language when all are
    equally likely before; ties go to the first name. Texts that are null or
    hold no letter are undetermined with score 0, and so are all if no
    language was learned.
    """
    model = docs.sparkSession.sparkContext.broadcast(chances)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = pieces(vocabulary)
        place: dict[str, int] = {}
        table = np.zeros((0, len(langs)))
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                counts = [word_counts(text) for text in part.column("text").to_pylist()]
                if len(place) > CACHED_WORDS:
                    place, table = {}, table[:0]
                new = list({word for words in counts for word in words if word not in place})
                if new and langs:
                    logs = forward(trie, new, model.value)
                    place.update(zip(logs, range(len(place), len(place) + len(logs))))
                    table = np.concatenate([table, np.array(list(logs.values()))])
                names, scores = [], []
                for words in counts:
                    if not words or not langs:
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    rows = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    total = np.fromiter(words.values(), np.float64, len(words)) @ table[rows]
                    best = int(total.argmax())
                    names.append(langs[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
                arrays = [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fourth document by the checksum of its id; a null id counts as an empty one."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 4 == 2


def language_id(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row per row of ``docs``.

    Learns from text and lang of the documents that are not held out and
    predicts from the text alone. Further columns are ignored, equal rows get
    equal results, and an empty table gives an empty result.
    """
    langs, chances = trained(docs.filter(~held_out()), vocabulary)
    found = predicted(docs, langs, chances, vocabulary)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
