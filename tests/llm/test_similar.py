"""The near-duplicate stage of the pipeline, against Jaccard similarities of all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from kerbflow.llm import similar, simhash


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def brute_groups(rows):
    """Smallest id of the group of each id, by similarities of all pairs."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            a, b = sets[i], sets[j]
            if i < j and (a == b or 10 * len(a & b) >= 8 * len(a | b)):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def corpus(seed):
    """Families whose members drift away from each other word by word, texts with one common passage, short texts."""
    r = random.Random(seed)

    def new(n):
        return [f"w{r.randrange(5000)}" for _ in range(n)]
    common, texts = new(40), ["", None, " ", "one", "ONE", "one two", "a b c d e", "a b c d e f", "a b c d f"]
    for _ in range(25):
        words = new(r.choice([8, 60, 120, 400]))
        for _ in range(8):
            texts.append(" ".join(words))
            for _ in range(max(1, len(words) // r.choice([60, 120, 200]))):
                words[r.randrange(len(words))] = r.choice(["x", "Y", *common])
    texts += [" ".join(new(r.randrange(60)) + common + new(r.randrange(60))) for _ in range(60)]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,sample", [(1, 16), (2, 1)])
def test_stage_keeps_one_text_of_each_group(spark, documents, monkeypatch, seed, sample):
    monkeypatch.setattr(similar, "SAMPLE", sample)
    rows = corpus(seed)
    want = brute_groups(rows)
    assert 50 < len(set(want.values())) < len(rows) - 60
    kept = corpus_pipeline.near_dedup(spark, documents(rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(rows)).collect()}
    assert got == want


def test_groups_of_a_family_and_its_strangers():
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(200)]
    sets = [np.unique(np.array(base[:200 - k] + [r.getrandbits(64) for _ in range(k)], np.uint64)) for k in [0, 5, 10, 15, 40, 60, 80] * 4]
    label = similar.groups(sets, 0.8)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert not similar.alike(a, b, 0.8) or label[i] == label[j]
    assert similar.groups([sets[0], sets[6]], 0.8) in ([0, 1], [1, 0])


@pytest.mark.parametrize("size", [1, 5, 40, 300, 20_000])
def test_sketches_never_rule_out_an_alike_pair(size):
    """Pairs at the very bound of the similarity, of all sizes, also with full classes."""
    r = np.random.default_rng(size)
    for _ in range(20):
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
        drop = r.integers(0, len(a) // 9 + 1)
        b = np.unique(np.concatenate([a[drop:], r.integers(0, 1 << 63, r.integers(0, len(a) // 9 + 1), dtype=np.uint64)]))
        if similar.alike(a, b, 0.8):
            one, two = (np.frombuffer(similar.sketch(x), np.uint8) for x in (a, b))
            assert similar.possible(two[None], np.array([len(b)]), one, len(a), 0.8).all()
    strange = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
    if 40 <= size <= 300:
        assert not similar.possible(np.frombuffer(similar.sketch(strange), np.uint8)[None], np.array([len(strange)]),
                                    np.frombuffer(similar.sketch(a), np.uint8), len(a), 0.8).any()


def test_pairs_of_a_family_grow_with_its_size(spark, documents, monkeypatch):
    """Copies of one text with up to three words changed: about half of all pairs are alike, few of them are ever formed."""
    r, rows, formed = random.Random(3), [], []
    base = [f"w{r.randrange(5000)}" for _ in range(150)]
    for i in range(300):
        words = list(base)
        for _ in range(r.randrange(4)):
            words[r.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    candidates = similar.candidate_links

    def counted(*args):
        pairs = candidates(*args)
        formed.append(pairs.count())
        return pairs
    monkeypatch.setattr(similar, "candidate_links", counted)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(rows)).collect()}
    assert got == brute_groups(rows)
    assert sum(formed) < 20 * len(rows)


def test_a_pair_leaves_the_exact_way_once(spark, documents, monkeypatch):
    """However many tokens two sets share, and on whatever task they meet; the tokens decide there whether they share enough."""
    r, base = random.Random(7), [f"w{i}" for i in range(120)]
    texts = []
    for i in range(80):
        words = list(base)
        for _ in range(r.randrange(1, 7)):
            words[r.randrange(len(words))] = f"x{i}"
        texts.append(" ".join(words))
    sets = (similar.with_sets(documents(list(enumerate(texts))), ["doc_id"], "text", 5, 0.8).dropDuplicates(["node"])
            .selectExpr("*", "node AS label").persist())
    made, plain = spark.sparkContext.accumulator(0), type(sets).mapInArrow

    def counted(self, func, schema, *args):
        def inner(batches):
            for batch in func(batches):
                if func.__name__ == "join":
                    made.add(batch.num_rows)
                yield batch
        return plain(self, inner, schema, *args)
    monkeypatch.setattr(type(sets), "mapInArrow", counted)
    every = spark.sparkContext.broadcast(np.full((1 << similar.RECURRING_POWER) // 8, 255, np.uint8))
    pairs = [tuple(row) for row in similar.candidate_links(sets, every, 0.8, "all").collect()]
    own = similar.shingle_sets([t.encode() for t in texts], 5)
    alike = {tuple(sorted((similar.node(a), similar.node(b)))) for a in own for b in own if similar.node(a) != similar.node(b) and similar.alike(a, b, 0.8)}
    assert alike and alike <= set(pairs)
    assert len(set(pairs)) < 80 * 79 // 2
    assert made.value == len(pairs) == len(set(pairs))
    sets.unpersist()


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_the_smallest_shared_token_decides_where_a_pair_counts(monkeypatch, held):
    monkeypatch.setattr(similar, "HELD", held)
    r = np.random.default_rng(4)
    lists = [np.unique(r.integers(-9, 9, r.integers(1, 12))) for _ in range(30)]
    i, j = np.triu_indices(len(lists), 1)
    for token in (-9, 0, 5):
        for least in (1, 3):
            got = similar._met_first(np.full(len(lists), token), pa.chunked_array([[x.tobytes() for x in lists]], pa.binary()), i, j, np.full(len(i), least))
            common = [np.intersect1d(lists[a], lists[b]) for a, b in zip(i, j)]
            assert got.tolist() == [len(c) >= least and c[0] == token for c in common]


def test_shared_tokens_count_once_in_each_part():
    """Sets of up to 12 tokens in 1, 2 or 4 parts: over all tokens where two sets meet, their shared tokens are counted once."""
    r = np.random.default_rng(6)
    lists = [np.unique(r.integers(-9, 9, r.integers(1, 12))) for _ in range(30)]
    parts = 1 << r.integers(0, 3, len(lists))
    i, j = np.triu_indices(len(lists), 1)
    total, left = np.zeros(len(i), int), np.zeros(len(i), int)
    for token in range(-9, 9):
        own = pa.chunked_array([[x[(x ^ token) & (p - 1) == 0].tobytes() for x, p in zip(lists, parts)]], pa.binary())
        here = np.array([token in lists[a] and token in lists[b] for a, b in zip(i, j)])
        n = similar._shared_first(np.full(len(lists), token), own, parts, i[here], j[here])
        total[here] += n
        left[here] += n > 0
    assert total.tolist() == [len(np.intersect1d(lists[a], lists[b])) for a, b in zip(i, j)]
    assert (left <= np.maximum(parts[i], parts[j])).all()
    assert similar.part_count(np.array([0, 1, similar.PART, similar.PART + 1, 4 * similar.PART])).tolist() == [1, 1, 1, 2, 4]


def dealt_out(monkeypatch, spark, frame):
    """Rows and bytes that sets send to their tokens from now on."""
    rows, size, plain = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), frame.mapInArrow

    def counted(self, func, schema, *args):
        def inner(batches):
            for batch in func(batches):
                if func.__name__ == "places":
                    rows.add(batch.num_rows)
                    size.add(batch.get_total_buffer_size())
                yield batch
        return plain(self, inner, schema, *args)
    monkeypatch.setattr(frame, "mapInArrow", counted)
    return rows, size


def test_a_full_filter_moves_no_token_of_one_set_alone(spark, documents, monkeypatch):
    """As many tokens recur in a large table as the filter has bits; what is sent must follow the tokens that recur."""
    r = random.Random(8)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(400)) for _ in range(40)]
    rows = list(enumerate([*texts, texts[0] + " x", " ".join(texts[1].split()[:200] + texts[2].split()[:200])]))
    monkeypatch.setattr(similar, "bits_of", lambda rows, column, power: np.full(1 << power >> 3, 255, np.uint8))
    docs = documents(rows)
    sent, _ = dealt_out(monkeypatch, spark, type(docs))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got == brute_groups(rows)
    # Three ways, five texts that share tokens of which each has 80 or so.
    assert 0 < sent.value < 3 * 5 * 85


def test_what_long_sets_bring_along_grows_with_their_size(spark, documents, monkeypatch):
    words = [f"w{i}" for i in range(8000)]
    texts = [" ".join(words[:7000]), " ".join(words[1000:]), " ".join(["x", *words[:6900]])]
    sets = (similar.with_sets(documents(list(enumerate(texts))), ["doc_id"], "text", 5, 0.8).selectExpr("*", "node AS label").persist())
    tokens = sum(len(r["tokens"]) for r in sets.collect())
    _, sent = dealt_out(monkeypatch, spark, type(sets))
    every = spark.sparkContext.broadcast(np.full((1 << similar.RECURRING_POWER) // 8, 255, np.uint8))
    pairs = {frozenset((r["a"], r["b"])) for r in similar.candidate_links(sets, every, 0.8, "all").collect()}
    nodes = [similar.node(own) for own in similar.shingle_sets([t.encode() for t in texts], 5)]
    assert frozenset((nodes[0], nodes[2])) in pairs
    assert 0 < sent.value < tokens * 1024
    sets.unpersist()
