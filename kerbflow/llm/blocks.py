"""Word spans and hashes of a piece of text columns, computed on the bytes of all its rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from kerbflow.llm.rows import FOLD_WORDS

BASE = 0x9E3779B97F4A7C15
UNFOLD = pow(BASE, -1, 1 << 64)
#: Is this byte part of a word: all but white space, or letters and digits only.
SPACED = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
FOLD = np.frombuffer(FOLD_WORDS, np.uint8)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, in place."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def powers(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        made = np.full(max(n, 1 << 16), base, np.uint64)
        made[0] = 1
        known = _powers[base] = np.multiply.accumulate(made)
    return known[:n]


@dataclass
class Block:
    """Bytes of all rows, where each row begins, and the words in them."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    first: np.ndarray  # of each row, its first word; one more than rows

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())


def column_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is empty."""
    values = values.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    if not len(values) or values.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def block(values: pa.Array, inside: np.ndarray = SPACED) -> Block:
    data, offsets = column_bytes(values)
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return Block(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(b: Block, fold: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    data = b.data if fold is None else fold[b.data]
    n = len(data)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=summed[1:])
    return mix((summed[b.ends] - summed[b.starts]) * powers(UNFOLD, n + 1)[b.starts])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of k values in a row, for every place where k follow; rows are not looked at."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(BASE)
        out += h[j:j + n]
    return mix(out)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Least of w values in a row, for every place where w follow."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    have = 1
    while have * 2 <= w:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[:n], h[w - have:w - have + n])
