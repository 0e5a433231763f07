"""Suffix-array dedup by bytes: two-stage suffix sorting and common prefixes of neighbours."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from kerbflow.llm.recurring import Units, merged, with_recurring
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import map_texts

WINDOW, GRAM = 200, 32
UNITS = Units(WINDOW, GRAM, words=False)


def byte_windows(body: bytes) -> list[bytes]:
    return [body[i:i + WINDOW] for i in range(len(body) - WINDOW + 1)]


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than the suffix that starts one byte later; an end is smaller than all."""
    n = len(data)
    change = np.append(np.flatnonzero(data[1:] != data[:-1]) + 1, n)
    following = change[np.searchsorted(change, np.arange(n), side="right")] if n else change[:0]
    out = np.zeros(n, bool)
    known = following < n
    out[known] = data[following[known]] > data[np.flatnonzero(known)]
    return out


def sort_suffixes(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes in the order of their first `depth` bytes at least.

    Two stages: suffixes smaller than their successors are sorted directly; every other one follows from its successor,
    in one scan over the buckets of first bytes. A suffix is needed if it is wanted or lies between a wanted one and the
    next directly sorted one.
    """
    n = len(data)
    if not n or not wanted.any():
        return np.zeros(0, np.int64)
    direct = smaller_than_next(data)
    stops = np.append(np.flatnonzero(direct), n)
    at = np.flatnonzero(wanted)
    span = np.zeros(n + 2, np.int64)
    np.add.at(span, at, 1)
    np.add.at(span, stops[np.searchsorted(stops, at)] + 1, -1)
    needed = np.cumsum(span[:n]) > 0
    start = np.flatnonzero(needed & direct)
    text = data.tobytes().decode("latin-1")
    keys = [text[p:p + depth] for p in start.tolist()]
    first = start[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)] if len(keys) else start
    cuts = np.searchsorted(data[first], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced = needed & ~direct
    order: list[np.ndarray] = []

    def before(found: np.ndarray) -> np.ndarray:
        """Suffixes one byte longer that are induced by those found, in the same order."""
        longer = found[found > 0] - 1
        return longer[induced[longer]]

    def deal(longer: np.ndarray) -> None:
        byte = data[longer]
        by = np.argsort(byte, kind="stable")
        longer, byte = longer[by], byte[by]
        edges = np.flatnonzero(byte[1:] != byte[:-1]) + 1
        for part in np.split(longer, edges) if len(longer) else ():
            buckets[data[part[0]]].append(part)

    deal(before(np.array([n])))
    for byte in range(256):
        found = np.concatenate(buckets[byte]) if buckets[byte] else start[:0]
        while len(found):
            order.append(found)
            longer = before(found)
            same = data[longer] == byte
            deal(longer[~same])
            found = longer[same]
        sorted_here = first[cuts[byte]:cuts[byte + 1]]
        if len(sorted_here):
            order.append(sorted_here)
            deal(before(sorted_here))
    order_all = np.concatenate(order)
    return order_all[wanted[order_all]]


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length, up to `depth`, of the common prefix of each suffix with the next one in the order, in steps of eight bytes."""
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    common = np.zeros(max(0, len(order) - 1), np.int64)
    alive = np.arange(len(common))
    for step in [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]:
        alive = alive[eight[order[alive] + step] == eight[order[alive + 1] + step]]
        common[alive] = step + 8
    return common


def find_repeats(stretches: list[tuple[bytes, int]]) -> list[list[tuple[int, int]]]:
    """Byte ranges of each stretch that recurring windows cover, from the suffix array of all stretches together."""
    data = np.frombuffer(b"".join(body for body, _ in stretches), np.uint8)
    offsets = np.cumsum([0, *(len(body) for body, _ in stretches)])
    size = np.diff(offsets)
    left = np.repeat(offsets[1:], size) - np.arange(len(data))  # bytes of the stretch from here on
    order = sort_suffixes(data, left >= WINDOW, WINDOW)
    equal = np.flatnonzero(common_prefixes(data, order, WINDOW) >= WINDOW)
    repeated = np.unique(np.concatenate([order[equal], order[equal + 1]]))
    owner = np.searchsorted(offsets, repeated, side="right") - 1
    new = np.ones(len(repeated), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (repeated[1:] > repeated[:-1] + WINDOW)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(repeated)) - 1
    covered: list[list[tuple[int, int]]] = [[] for _ in stretches]
    for b, e in zip(begin.tolist(), last.tolist() if len(begin) else []):
        own = owner[b]
        covered[own].append((int(repeated[b] - offsets[own]), int(repeated[e] - offsets[own]) + WINDOW))
    return [[(0, len(body))] if places > 1 else c for (body, places), c in zip(stretches, covered)]


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, and n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every text.

    A byte goes if any 200-byte string around it also starts anywhere else, in this text or another; all places go, the
    first too. Strings are judged on the input and never cross texts. Null is empty; texts below 200 bytes lose nothing;
    copies of a longer text lose all. A cut may fall inside a character, so what is kept is binary. Ids may be null or
    repeated; each row counts as a text of its own.
    """
    found = with_recurring(docs.select(id_column, text), id_column, text, UNITS, find_repeats, byte_windows)

    def make():
        def derive(texts, runs, whole):
            out = []
            for t, r, w in zip(texts, runs, whole):
                spans = [(0, len(t))] if w and len(t) >= WINDOW else merged(r)
                parts, at = [], 0
                for low, high in spans:
                    parts.append(t[at:low])
                    at = high
                kept = b"".join([*parts, t[at:]])
                out.append((len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            return [list(c) for c in zip(*out)] if out else [[] for _ in range(5)]
        return derive

    return map_texts(found, [id_column], text, make, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
                     use=("_runs", "_whole"))


@query("op9_suffix_array_dedup")
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
