"""Words of a column of texts as 64-bit hashes, by whole arrays.

Texts are taken as UTF-8 bytes. A word is a run of bytes of a class; since
every byte of a character beyond ASCII belongs to all classes used here, runs
of bytes are runs of characters. A word's hash is a polynomial of its bytes
modulo 2**64, taken as a difference of running sums and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

LETTERS_DIGITS = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    LETTERS_DIGITS[_first : _last + 1] = True

_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A value per byte, the same for upper and lower case of A to Z.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))[_LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, CHUNK + 1)
_DOWN = _powers(_UNBASE, CHUNK + 1)


@dataclass
class Words:
    """Words of consecutive texts: the words of text i are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts())


def split_words(texts: pa.Array, kind: np.ndarray) -> Words:
    """The words of all texts of an array; A to Z are hashed like a to z."""
    global _UP, _DOWN
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = kind[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    # Texts lie side by side: the first byte of one may go on from the last of another.
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begins[first] |= inside[1 + first]
    stops[last] |= inside[1 + last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if n >= len(_UP):
        _UP, _DOWN = _powers(_BASE, 2 * n), _powers(_UNBASE, 2 * n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _UP[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _DOWN[starts])
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; windows may run over the end of a text."""
    n = max(0, len(hashes) - size + 1)
    total = np.full(n, size * 0x51, np.uint64)
    for i in range(size):
        total = (total + hashes[i : i + n]) * np.uint64(_BASE)
        total ^= total >> np.uint64(29)
    return mix(total)


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about a megabyte of text each, or a single longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = upto[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, done + CHUNK, "right")))
        yield batch.slice(at, stop - at)
        at = stop
