"""Fingerprints, the trie self-join and components, against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from kerbflow.llm import simhash
from kerbflow.llm.components import components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(seed, n, families):
    r = random.Random(seed)
    out = set()
    for _ in range(families):
        base = r.getrandbits(64)
        out.add(base)
        for _ in range(n):
            out.add(base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    return sorted(out | {0, (1 << 64) - 1})


def all_pairs(values, budget):
    return {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() <= budget}


@pytest.mark.parametrize("text", [None, "", " \n ", "One", "one TWO", "a b c", "Ä é b ü " * 40, "x " * 3])
def test_fingerprint_of_small_texts(text):
    assert simhash.fingerprint((text or "").encode()) % (1 << 64) == brute_fingerprint(text)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_pairs_are_all_pairs_within_the_budget(budget):
    values = near(1, 30, 10)
    got = simhash.trie_pairs(np.array(values, np.uint64), budget)
    assert {tuple(p) for p in got.tolist()} == all_pairs(values, budget) and len(got) == len(all_pairs(values, budget))


@pytest.mark.parametrize("hot", [10**6, 3, 0])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    values = near(2, 25, 12)
    frame = spark.createDataFrame([(v - (1 << 64) if v >= 1 << 63 else v,) for v in values], "fp long")
    edges = simhash.links(frame)
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in all_pairs(values, 2):
        parent[find(j)] = find(i)
    groups = {}
    for i, v in enumerate(values):
        s = v - (1 << 64) if v >= 1 << 63 else v
        groups.setdefault(find(i), set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (6000, 6001), (6001, 6000), (6000, 6001)]
    random.Random(1).shuffle(pairs)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1100)} == {1000} and got[6001] == 6000 and 5000 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_row_gets_its_component_and_one_row_of_each_stays(documents):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (7, None), (8, ""), (None, "p q r"), (None, None), (9, "k l m n o p"), (9, "u v w")]
    got = sorted(((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (7, 7), (8, 7), (-1, None), (-1, 7), (9, 9), (9, 9)], key=str)
    kept = simhash.one_of_each(documents(rows))
    assert kept.columns == ["doc_id", "text", "key", "score"]
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted(
        [(3, "a b c d"), (-1, ""), (-1, "p q r"), (9, "k l m n o p"), (9, "u v w")])
    assert simhash.near_duplicates(documents([])).count() == 0 and simhash.one_of_each(documents([])).count() == 0
