"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kerbflow.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(map(str, out))


def edited(r, word, letters):
    at, kind = r.randrange(len(word)), r.randrange(3)
    return word[:at] + ("" if kind == 0 else r.choice(letters)) + word[at + (kind != 2):]


def corpus(seed, letters="abcdeéÿ×"):
    r = random.Random(seed)
    words, frequent = [], ["".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(12)]
    for w in frequent:
        words += [w] * r.choice([5, 30, 200])
        for _ in range(12):
            v = edited(r, w, letters)
            words += [v] * r.choice([3, 5, 6, 25, 40])
            words += [edited(r, v, letters)] * r.choice([4, 5])
    words += ["z" * 3000] * 30 + ["z" * 2999 + "y"] * 6 + ["chainaa"] * 700 + ["chainab"] * 130 + ["chainbb"] * 26 + ["chaibbb"] * 5
    r.shuffle(words)
    words = [w.upper() if w.isascii() and r.random() < 0.1 else w for w in words]
    rows = [(i, r.choice([" ", "\n", "3", ", "]).join(words[i::97])) for i in range(97)]
    return [*rows, (None, "null id " * 6 + "letters letters letters letters letters"), (500, None), (501, ""), (502, "ab 12 ..")] + rows[:5]


@pytest.mark.parametrize("seed,symbols", [(1, None), (2, 2), (3, 16)])
def test_forms_and_roots_of_a_small_vocabulary(spark, documents, seed, symbols):
    rows = corpus(seed)
    found = spelling.spelling_variants(documents(rows).repartition(3), symbols=symbols)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted(map(str, map(tuple, found.collect()))) == want
    assert sum("None" not in w for w in want) > 10


def test_a_filter_with_few_bits_loses_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(spelling, "FILTER_POWER", 3)
    rows = corpus(4)
    assert sorted(map(str, map(tuple, spelling.spelling_variants(documents(rows)).collect()))) == brute(rows)


def test_no_words(spark, documents):
    assert spelling.spelling_variants(documents([])).count() == 0
    assert spelling.spelling_variants(documents([(1, None), (2, ""), (3, "short 123")])).count() == 0


@pytest.mark.parametrize("block", [3, 1 << 21])
@pytest.mark.parametrize("length", [1, 2, 6])
def test_neighbourhoods_are_whole_and_without_repeats(monkeypatch, length, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    r, symbols = random.Random(length), 3
    rows = [[r.randint(1, symbols) for _ in range(length)] for _ in range(20)]
    found = [[] for _ in rows]
    for row, code in spelling.neighbourhoods(np.array(rows, np.uint64), symbols):
        for i, c in zip(row.tolist(), code.tolist()):
            found[i].append(c)
    for own, got in zip(rows, found):
        want = {tuple(own)} | {tuple(own[:i] + own[i + 1:]) for i in range(length)}
        want |= {tuple(own[:i] + [s] + own[i + 1:]) for i in range(length) for s in range(1, symbols + 1)}
        want |= {tuple(own[:i] + [s] + own[i:]) for i in range(length + 1) for s in range(1, symbols + 1)}
        want = {int(spelling.codes(np.array([w], np.uint64).reshape(1, -1))[0]) for w in want}
        assert len(got) == len(set(got)) and set(got) == want
