"""Substring dedup by words and by bytes, against a count of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kerbflow.llm import phrases, recurring, suffixes

rnd = random.Random(5)
WORDS = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("\n" if r.random() < 0.05 else "") for _ in range(n))


def brute(units, window, joined):
    seen = Counter(joined(u[i:i + window]) for u in units for i in range(len(u) - window + 1))
    out = []
    for u in units:
        gone = bytearray(len(u))
        for i in range(len(u) - window + 1):
            if seen[joined(u[i:i + window])] > 1:
                gone[i:i + window] = b"\1" * window
        out.append(gone)
    return out


def cases():
    shared, line = prose(60, 1), prose(12, 2)
    rows = [(1, prose(200, 3) + " " + shared + " " + prose(50, 4)), (2, prose(30, 5) + " " + shared), (3, None), (4, ""), (5, "one"),
            (6, prose(80, 6)), (7, prose(80, 6)), (8, prose(80, 6).replace("a", "b", 1)), (9, "so " * 500), (10, "so so " * 3),
            (11, (line + " ") * 9), (12, prose(34, 7)), (13, prose(34, 7)), (14, prose(35, 8)), (14, prose(35, 8)), (None, prose(90, 9)),
            (None, prose(90, 9)), (15, prose(20_000, 10) + shared[:300]), (16, "   \t\n ")]
    rows += [(100 + i, prose(40, 1000 + i) + " " + shared) for i in range(40)]
    return rows


@pytest.fixture(params=["whole grams", "units", "small units"])
def crowding(request, monkeypatch):
    if request.param != "whole grams":
        monkeypatch.setattr(recurring, "HOT_BYTES", 0)
    if request.param == "small units":
        for bound in ("SHARD_PASSAGES", "UNIT_STRETCHES", "LOT_BYTES"):
            monkeypatch.setattr(recurring, bound, 3)


def test_words_of_recurring_windows_go(spark, documents, crowding):
    rows = cases()
    got = sorted(((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in
                  phrases.remove_repeated_passages(documents(rows)).collect()))
    units = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    want = sorted((i or -1, len(u), sum(g), hashlib.sha256(" ".join(w for w, x in zip(u, g) if not x).encode()).hexdigest())
                  for (i, _), u, g in zip(rows, units, brute(units, 35, tuple)))
    assert got == want


def test_bytes_of_recurring_strings_go(spark, documents, crowding):
    rows = cases()
    got = sorted(((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in
                  suffixes.remove_repeated_bytes(documents(rows)).collect()))
    units = [(t or "").encode() for _, t in rows]
    want = sorted((i or -1, len(u), sum(g), len(re.findall(b"\1+", bytes(g))), hashlib.sha256(bytes(b for b, x in zip(u, g) if not x)).hexdigest())
                  for (i, _), u, g in zip(rows, units, brute(units, 200, bytes)))
    assert got == want


def test_empty_table_and_columns(spark, documents):
    out = phrases.remove_repeated_passages(documents([]))
    assert out.count() == 0 and out.columns[:3] == ["doc_id", "key", "score"]
    kept = phrases.remove_repeated_passages(documents([(1, None), (2, " two  spaces ")])).collect()
    assert {r["doc_id"]: (r["text"], r["key"], r["score"]) for r in kept} == {1: (None, "x", 1), 2: (" two  spaces ", "x", 1)}
    assert suffixes.remove_repeated_bytes(documents([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_two_stage_order_is_the_order_of_suffixes(seed):
    r = random.Random(seed)
    data = bytes(r.choice(b"abb\0\xff"[:2 + seed]) for _ in range(700)) + b"a" * 60
    order = suffixes.sort_suffixes(np.frombuffer(data, np.uint8), np.ones(len(data), bool), 1000)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    some = np.array([r.random() < 0.3 for _ in data])
    assert suffixes.sort_suffixes(np.frombuffer(data, np.uint8), some, 1000).tolist() == [i for i in order.tolist() if some[i]]


def test_equal_windows_share_a_gram_and_stretches_tile_all_windows():
    text = [prose(400, 20), prose(50, 21) + " " + prose(400, 20)[200:900], "so " * 100]
    for units in (phrases.UNITS, suffixes.UNITS):
        s = recurring.stretches(pa.array(text), units)
        h, first, _, _ = units.hashes(pa.array(text))
        windows = [max(0, n - units.window + 1) for n in np.diff(first)]
        assert [int(s["windows"][s["row"] == i].sum()) for i in range(3)] == windows
        grams: dict[tuple, set] = {}
        for row, gram, unit, n in zip(*(s[k].tolist() for k in ("row", "gram", "unit", "windows"))):
            for at in range(unit, unit + n):
                grams.setdefault(tuple(h[first[row] + at:first[row] + at + units.window].tolist()), set()).add(gram)
        assert all(len(g) == 1 for g in grams.values())
        assert s["again"][s["row"] == 2].all()
