"""The trie inside groups, and the bounds by which pairs of sets are ruled out before they are compared."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbflow.llm import similar
from kerbflow.llm.trie import forest, trie_pairs


def test_trie_of_groups_joins_each_with_itself():
    r = random.Random(4)
    groups = []
    for size in [1, 2, 0, 30, 1, 60, 2]:
        base = [r.getrandbits(64) for _ in range(3)]
        groups.append(sorted({r.choice(base) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(size)}))
    cuts = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
    got = trie_pairs(np.array(sum(groups, []), np.uint64), 3, cuts=cuts)
    want = {(low + i, low + j) for low, g in zip(cuts.tolist(), groups) for i in range(len(g)) for j in range(i + 1, len(g))
            if (g[i] ^ g[j]).bit_count() <= 3}
    assert {tuple(p) for p in got.tolist()} == want and len(got) == len(want) > 50
    assert len(forest(got)) < len(want)


@pytest.mark.parametrize("size", [1, 3, 10, 100, 3000])
def test_alike_sets_share_as_many_tokens_as_the_bound_says(size):
    r = np.random.default_rng(size)
    seen = 0
    for _ in range(300):
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
        kept = a[r.integers(0, len(a) // 5 + 1):] if r.random() < 0.5 else r.permutation(a)[r.integers(0, len(a) // 9 + 1):]
        b = np.unique(np.concatenate([kept, r.integers(0, 1 << 63, r.integers(0, len(a) // 9 + 1), dtype=np.uint64)]))
        if len(b) and similar.alike(a, b, 0.8):
            seen += 1
            first = [own[:len(own) - similar.least_common(len(own), 0.8) + 1] for own in (a, b)]
            assert len(np.intersect1d(*first)) >= similar.least_shared(np.array([len(a)]), np.array([len(b)]), 0.8)[0]
    assert seen > 30


def long_texts():
    r = random.Random(3)

    def new(n):
        return [f"w{r.randrange(10**6)}" for _ in range(n)]
    passage = new(60)
    texts = [" ".join(new(8000) + passage + new(8000)) for _ in range(6)]
    words = texts[0].split()
    return [*enumerate(texts), (6, " ".join(["x", *words[1:]])), (7, " ".join(words[3000:]))]


def test_long_texts_with_one_common_passage_are_no_candidates(spark, documents):
    """Sizes and sketches alone cannot tell texts of 16,000 words apart; the shared tokens do."""
    from kerbflow.llm.simhash import _rows, near_duplicates

    docs = documents(long_texts())
    rows = _rows(docs, "doc_id", "text", 5, 0.8).withColumn("label", F.col("node"))
    every = spark.sparkContext.broadcast(np.full(1 << similar.RECURRING_POWER >> 3, 255, np.uint8))
    names = {r["node"]: r["doc_id"] for r in rows.select("doc_id", "node").collect()}
    for others in (False, True):
        pairs = {frozenset((names[r["a"]], names[r["b"]])) for r in similar.candidate_links(rows, every, 0.8, others).collect()}
        assert len(pairs) >= (3 if others else 2) and pairs <= {frozenset(p) for p in [(0, 6), (0, 7), (6, 7)]}
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0, 7: 0}
