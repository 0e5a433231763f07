"""Scans of single texts: licences, toxicity, quality scores and rules, packing, URLs, decontamination."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kerbflow.llm import classifier, decontaminate, licenses, packing, quality_rules, toxicity, url_filter
from kerbflow.llm.labelled import remainder, sample
from kerbflow.llm.rows import folded_words

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b\n" * 3000), (5, "a b\n" * 3000), (None, "x y z"), (6, "é" * 5000), (7, "<|endoftext|> ÀB ſ​1st")]


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("text", [t for _, t in ODD])
def test_folded_words(text):
    assert [w.decode() for w in folded_words((text or "").encode())] == word_list(text)


def test_matching_statistics_are_the_longest_suffixes_in_a_template():
    r = random.Random(3)
    templates = {"a": " ".join(r.choice("pqrs") for _ in range(40)), "b": " ".join(r.choice("qrst") for _ in range(30))}
    automaton = licenses.Automaton.build(templates, {"p q": "pq", "t t": "tt"}, min_match=1)
    words = [r.choice("pqrstx").encode() for _ in range(500)]
    parts = [t.encode().split() for t in templates.values()] + [[b"p", b"q"], [b"t", b"t"]]
    known = {tuple(p[i:j]) for p in parts for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
    longest = [max((n for n in range(i + 2) if tuple(words[i + 1 - n:i + 1]) in known or n == 0), default=0) for i in range(500)]
    ends = {i + 1: longest[i] for i in range(500) if longest[i] and (i == 499 or longest[i + 1] != longest[i] + 1)}
    places, matches = automaton.scan(words)
    assert {end: size for end, size, _ in matches} == ends
    assert sorted((p, label) for p, _, label in places) == sorted(
        (i, "pq" if words[i] == b"p" else "tt") for i in range(499) if words[i:i + 2] in ([b"p", b"q"], [b"t", b"t"]))


def test_license_scan_rows(documents):
    mit = licenses.TEMPLATES["mit"][0]
    rows = [*ODD, (10, "MIT License! mit-license"), (11, f"x {mit} y"), (12, " ".join(mit.split()[:12])), (13, "GNU General Public  License, CC BY")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(rows)).collect()}
    assert (got[10]["n_base"], got[10]["first_word"], got[10]["last_word"], got[10]["base_labels"]) == (2, 0, 2, "mit")
    assert (got[11]["base_labels"], got[11]["labels"]) == ("", "mit") and got[11]["score"] == 1.0
    assert (got[12]["labels"], got[12]["first_word"]) == ("", None) and 0 < got[12]["score"] < 0.6
    assert (got[13]["n_base"], got[13]["labels"]) == (2, "cc-by,gpl")
    assert (got[1]["n_words"], got[1]["score"]) == (0, 0.0) and licenses.scan_licenses(documents([])).count() == 0


def brute_spans(words, templates, least):
    """(template, first, last, covered) by plain loops: longest matches at every word, then all chains of them."""
    def inside(part):
        return [(t, k + len(part)) for t, own in enumerate(templates) for k in range(len(own) - len(part) + 1) if own[k:k + len(part)] == part]
    sizes = []  # of the longest match that ends at each word
    for i in range(len(words)):
        sizes.append(next((n for n in range(i + 1, 0, -1) if inside(words[i + 1 - n:i + 1])), 0))
    maximal = [(i + 1, n) for i, n in enumerate(sizes) if n >= least and (i + 1 == len(words) or sizes[i + 1] != n + 1)]
    best, steps = {}, []  # all (template, position, covered, first) reached so far
    for stop, n in maximal:
        fresh = []
        for t, end in inside(words[stop - n:stop]):
            ways = [(c - max(0, p - (end - n)), first) for own, p, c, first in steps if own == t and p < end]
            gain, first = max(ways, default=(0, 0))
            fresh.append((t, end, gain + n, first) if gain > 0 else (t, end, n, stop - n))
            best[t] = max(best.get(t, (0, 0, 0)), (fresh[-1][2], 1 - stop, fresh[-1][3]))
        steps += fresh
    return [(t, first, -last, covered / len(templates[t])) for t, (covered, last, first) in sorted(best.items())]


@pytest.mark.parametrize("seed", range(6))
def test_license_spans_against_plain_loops(seed):
    r = random.Random(seed)
    made = lambda n: [r.choice("abcdefgh").encode() for _ in range(n)]
    templates = [made(r.randint(5, 25)) for _ in range(4)]
    templates.append(templates[0][2:] + made(3))
    automaton = licenses.Automaton.build({str(i): [b" ".join(t).decode()] for i, t in enumerate(templates)}, {}, min_match=3)
    for _ in range(30):
        words = made(5)
        for _ in range(r.randint(0, 5)):
            own = r.choice(templates)
            low = r.randrange(len(own))
            words += own[low:low + r.randint(2, 20)] + made(r.randint(0, 3))
        _, matches = automaton.scan(words)
        assert automaton.spans(matches) == brute_spans(words, templates, 3)


def test_later_passages_of_a_licence_are_found(documents):
    late = licenses.TEMPLATES["mit"][2]
    got = licenses.scan_licenses(documents([(1, "some words before " + late + " after")])).first()
    assert got["labels"] == "mit" and got["base_labels"] == ""
    span = max(got["spans"], key=lambda x: x["cover"])
    assert (span["label"], span["first_word"], span["cover"]) == ("mit", 3, 1.0) and span["last_word"] == got["n_words"] - 2


@pytest.mark.parametrize("text,hits", [
    ("You idiot.", 1), ("IDIOT idiot", 2), ("1d10t and ｉｄｉｏｔ and іdіоt", 3), ("idiotically", 0), ("a trash can", 0), ("trash can trash", 1),
    ("í d", 0), ("mo​ron", 1), ("", 0), ("STUP1D!", 1)])
def test_folding_boundaries_and_exceptions(text, hits):
    words = sorted(toxicity.LEXICON)
    assert sum(toxicity.Matcher(words, toxicity.EXCEPTIONS).count(text.encode())[1].values()) == hits


@pytest.fixture
def labelled(spark):
    def make(rows):
        return spark.createDataFrame([(i, label, t) for i, (t, label) in enumerate(rows)], "_order long, _label int, _text string")
    return make


def test_toxicity_learns_and_survives_no_labels(labelled, documents):
    r = random.Random(2)
    clean = [" ".join(r.choice(["der", "tag", "geht", "gut", f"w{r.randrange(99)}"]) for _ in range(60)) for _ in range(80)]
    rude = [t + " blöfiwort blöfich" for t in clean[:20]] + [t + " you idiot moron" for t in clean[20:40]]
    model = toxicity.fit_toxicity(labelled([(t, 0) for t in clean] + [(t, 1) for t in rude]))
    new = [(1, "der tag blöfisch geht"), (2, clean[5] + " Id1ot, loser"), (3, clean[6]), *[(20 + i, t) for i, (_, t) in enumerate(ODD)]]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents(new), model, ["doc_id"]).collect()}
    assert got[1] > 0.5 and got[2] > 0.5 and max(v for k, v in got.items() if k > 2) < 0.5
    assert toxicity.fit_toxicity(labelled([])).slope > 0


def test_quality_model_learns_and_survives_no_labels(labelled, documents):
    r = random.Random(4)
    good = [" ".join(f"{r.choice('abcdefgh')}{r.randrange(60)}" for _ in range(80)) for _ in range(150)]
    bad = [" ".join([w, "|", w.upper()] * 1) for w in good]
    bad = [" ".join(f"{x} | {x}!!" for x in t.split()[:30]) for t in good]
    model = classifier.fit_quality(labelled([(t, 1) for t in good[:100]] + [(t, 0) for t in bad[:100]]))
    rows = [*[(i, t) for i, t in enumerate(good[100:])], *[(1000 + i, t) for i, t in enumerate(bad[100:])], *[(5000 + i, t) for i, (_, t) in enumerate(ODD)]]
    got = {r["doc_id"]: r["score"] for r in classifier.score_quality(documents(rows), model, ["doc_id"]).collect()}
    assert min(v for k, v in got.items() if k < 1000) > 0.7 > max(v for k, v in got.items() if 1000 <= k < 5000)
    assert all(0 <= v <= 1 for v in got.values()) and got[5000] == got[5001] == got[5002]
    empty = classifier.fit_quality(labelled([]))
    assert classifier.score_quality(documents([(1, "x")]), empty, ["doc_id"]).first()["score"] == 0.5


def test_sample_is_bounded_and_keeps_out_held_out_ids(spark, documents):
    docs = documents([(i, f"t{i}") for i in range(400)] + [(7, "again"), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(500)] + [(7, 0, 0), (None, 1, 1), (9, None, 1)], "doc_id long, quality int, toxic int")
    rows = sample(docs, labels, "doc_id", "text", "quality", remainder("doc_id", 4) != 2, 100).collect()
    assert len(rows) <= 100
    every = sample(docs, labels, "doc_id", "text", "quality", remainder("doc_id", 4) != 2, 10_000).collect()
    ids = {int(r["_text"][1:]) if r["_text"] != "again" else 7 for r in every}
    assert ids == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2} and len(every) == len(ids)


def repeated(words):
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, hit = Counter(windows), bytearray(len(words))
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit[i:i + 8] = b"\1" * 8
    return sum(hit)


def test_measures_and_verdicts(documents):
    r = random.Random(6)
    rows = [*ODD, *[(100 + i, " ".join(r.choice("abcd") * r.randrange(1, 3) for _ in range(r.randrange(120))) + "\nq #*|<>&%$\n\nq #*|<>&%$") for i in range(40)]]
    got = quality_rules.judge_quality(documents(rows), ["doc_id"]).collect()
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((i or -1, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeated(w)))
    assert sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == sorted(want)
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) and not (r["kept"] and r["base_failed"]) for r in got)
    assert quality_rules.judge_quality(documents([]), ["doc_id"]).count() == 0


def test_expectation_maximisation_matches_a_loop_over_texts(spark):
    r, names = random.Random(8), list(quality_rules.votes())
    rows = []
    for _ in range(600):
        good = r.random() < 0.8
        rows.append(tuple(-(r.random() < (0.02 if good else 0.5)) if n in quality_rules.FAULTS else r.choice([0, 1 if r.random() < (0.95 if good else 0.4) else -1])
                          for n in names))
    model = quality_rules.fit_rules(spark.createDataFrame(rows, ", ".join(f"v_{n} int" for n in names)), names, rounds=4)
    fault = [n in quality_rules.FAULTS for n in names]
    prior = [(quality_rules.FAULT_ON_GOOD, quality_rules.FAULT_ON_BAD) if f else (quality_rules.VOTE_ON_GOOD, quality_rules.VOTE_ON_BAD) for f in fault]
    p = [tuple(np.array(c) / sum(c) for c in pair) for pair in prior]
    share = quality_rules.GOOD / (quality_rules.GOOD + quality_rules.BAD)
    for _ in range(4):
        sums = [[np.array(c, float) for c in pair] for pair in prior]
        g_all = quality_rules.GOOD
        for row in rows:
            odds = share / (1 - share)
            for v, f, (a, b) in zip(row, fault, p):
                if v == -1 or f or v == 1:
                    k = 0 if v == -1 else 1
                    odds *= a[k] / b[k]
            g = odds / (1 + odds)
            g_all += g
            for s, v, f in zip(sums, row, fault):
                if v == -1 or f or v == 1:
                    s[0][0 if v == -1 else 1] += g
                    s[1][0 if v == -1 else 1] += 1 - g
        share = g_all / (len(rows) + quality_rules.GOOD + quality_rules.BAD)
        p = [tuple(c / c.sum() for c in pair) for pair in sums]
    assert model["good"] == pytest.approx(share)
    for n, (a, b) in zip(names, p):
        assert model[n][0] == pytest.approx(tuple(a)) and model[n][1] == pytest.approx(tuple(b))


def test_packing_round_trip(documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.word_bpe())
    r = random.Random(9)
    rows = [*ODD, *[(100 + i, " ".join(r.choice(["Hello", "wörld", "naïve", "x1y2", "it's"]) for _ in range(r.choice([3, 50, 400, 5000])))) for i in range(60)]]
    pieces = [r.asDict() for r in packing.pack_texts(documents(rows).repartition(3), "doc_id", packing.word_bpe).collect()]
    by_sequence: dict[int, list] = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and len(parts) <= packing.SEGMENTS
    want = Counter((i or -1, *x) for i, t in rows for x in [whole(library, t)])
    got: Counter = Counter()
    for i in {i for i, _ in rows}:
        ids = [p for p in pieces if p["doc_id"] == i]
        copies = sum(1 for j, _ in rows if j == i)
        totals = {p["doc_tokens"] for p in ids}
        assert len(totals) == 1 and sum(p["length"] for p in ids) == copies * totals.pop()
        one = sorted(ids, key=lambda p: p["start"])
        if copies == 1:
            at, text = 0, next(t for j, t in rows if j == i)
            tokens = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            for p in one:
                assert p["start"] == at and p["ids_crc32"] == zlib.crc32(tokens[at:at + p["length"]].tobytes())
                at += p["length"]
            got[(i or -1, at)] += 1
    assert all(k in want for k in got)
    assert packing.pack_texts(documents([]), "doc_id", packing.word_bpe).count() == 0


def whole(library, text):
    return (len(library.encode(text or "", add_special_tokens=False).ids) + 1,)


def test_sequences_respect_every_limit():
    r = np.random.default_rng(1)
    packer = packing.Packer((64, 5, 20))
    items = [packing.Piece(i, 0, np.arange(n), int(n), int(f)) for i, (n, f) in enumerate(zip(r.integers(1, 20, 300), r.integers(0, 20, 300)))]
    packer.add(items)
    placed = 0
    for sequence in packer.sequences(0):
        assert sum(len(p.ids) for p in sequence) <= 64 and len(sequence) <= 5 and sum(p.need[2] for p in sequence) <= 20
        placed += sum(len(p.ids) for p in sequence)
    assert placed == sum(len(p.ids) for p in items)
    parts = list(packing.halves([packing.Piece(0, 0, np.arange(100), 100), packing.Piece(1, 0, np.arange(33), 33)]))
    assert [sum(len(p.ids) for p in s) for s in parts] == [128, 4, 1]


def test_url_rules_and_reputation(spark):
    urls = [None, "", "no scheme", "http://ORG/x", "http://a.Example.org/es/1", "http://example.org/en/12?q", "https://x.com/de/", "https://x.com/fr/", "http://xcom/de/1",
            "http://notexample.org:80/es/1", "http://example.org", "http://good.net/1", "http://bad.net/1", "http://u@new.bad.net/2", "http://1.2.3.4/a#b"]
    pages = spark.createDataFrame([(i, u, 0) for i, u in enumerate(urls)], "page_id long, url string, host int")
    outcomes = spark.createDataFrame([("http://good.net/", 1)] * 60 + [("http://bad.net/", 0)] * 60 + [("http://mixed.net/", None)], "url string, good int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(
        pages.drop("host"), outcomes, url_filter.ALLOW, url_filter.BLOCK, ["page_id"]).collect()}
    assert got[0][:3] == got[1][:3] == got[2][:3] == ("", "", None)
    assert got[3] == ("org", "/x", "org/", "allow") and got[4] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[5] == ("example.org", "/en/12", "example.org/en/1", "block") and got[6][2:] == ("com/de/", "block") and got[7][2:] == ("com/fr/", "allow")
    assert got[8][2] is None and got[9][:3] == ("notexample.org:80", "/es/1", None) and got[10][:3] == ("example.org", "", None)
    assert got[11][3] == "allow" and got[12][3] == "block" and got[13][3] == "block"
    assert url_filter.filter_urls(pages.drop("host").limit(0), outcomes.limit(0), [], [], ["page_id"]).count() == 0


def test_registered_domains(spark):
    hosts = ["a.b.example.co.uk", "example.com", "x.example.com:80", "me@www.site.org", "1.2.3.4", "localhost", ""]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string").select(url_filter.domain_of(url_filter.F.col("h")).alias("d")).collect()
    assert [r["d"] for r in rows] == ["example.co.uk", "example.com", "example.com", "site.org", "1.2.3.4", "localhost", ""]


def test_contamination_finds_every_window(spark, documents):
    r = random.Random(11)
    vocabulary = [f"{c}{i}" for c in "abc" for i in range(9)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 7, 9, 10, 11, 25])))) for i in range(60)] + [(60, None), (61, ""), (None, "zz yy"), (62, items_of(12))]
    docs = [*ODD]
    for i in range(150):
        words = [r.choice(vocabulary) for _ in range(r.randrange(60))]
        at, item = r.randrange(len(words) + 1), r.choice(items)[1] or ""
        part = item.split()[:r.choice([10, 12, 30])]
        docs.append((100 + i, ", ".join([*words[:at], *part, *words[at:]]).upper()))
    got = decontaminate.contamination(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = word_list(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(item)
    want = []
    for i, text in docs:
        w, hit, found = word_list(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if (known := windows.get(tuple(w[k:k + size]))):
                    hit.update(range(k, k + size))
                    found |= known
        want.append((i or -1, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted(want)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(documents(docs), nothing).collect()} == {0}
    assert decontaminate.contamination(documents([]), nothing).count() == 0


def items_of(n):
    return " ".join(f"m{i}" for i in range(n))


def test_marks_are_shared_by_equal_windows():
    r = random.Random(12)
    text = " ".join(r.choice("abcd") for _ in range(500)).encode()
    _, [(_, at, marks)], _ = decontaminate.window_marks([text, text[100:]], (10,))
    words, second = text.split(), text[100:].split()
    seen: dict[tuple, set] = {}
    for a, m in zip(at.tolist(), marks.tolist()):
        window = words[a:a + 10] if a < len(words) else second[a - len(words):a - len(words) + 10]
        seen.setdefault(tuple(window), set()).add(m)
    assert all(len(x) == 1 for x in seen.values())


def test_sequences_closed_by_the_limit_of_segments_need_no_padding(documents):
    rows = [(i, "a b c d e") for i in range(5000)]
    pieces = packing.pack_texts(documents(rows).coalesce(1), "doc_id", packing.word_bpe)
    sizes = [r["n"] for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()]
    counts = [r["count"] for r in pieces.groupBy("sequence_id").count().collect()]
    assert max(counts) <= packing.SEGMENTS and sum((1 << (n - 1).bit_length()) - n for n in sizes) == 0
    assert sum(sizes) == sum(r["doc_tokens"] for r in pieces.select("doc_id", "doc_tokens").distinct().collect())


def test_ftrl_updates_against_a_plain_loop():
    """Per-coordinate follow-the-regularised-leader, written out with dictionaries."""
    r = random.Random(4)
    model, z, n, bias = classifier.Ftrl.empty(), {}, {}, [0.0, 0.0]

    def weight(zi, ni, l1=classifier.L1):
        if abs(zi) <= l1:
            return 0.0
        return -(zi - (l1 if zi > 0 else -l1)) / ((classifier.BETA + ni ** 0.5) / classifier.ALPHA + classifier.L2)
    for _ in range(400):
        label = r.randint(0, 1)
        value = {r.randrange(30) + 30 * label * r.randint(0, 1): r.uniform(0.1, 2) for _ in range(8)}
        index = np.array(sorted(value))
        model.update(index, np.array([value[i] for i in index.tolist()]), label)
        w = {i: weight(z.get(i, 0.0), n.get(i, 0.0)) for i in value}
        wb = weight(*bias, 0.0)
        g = 1 / (1 + np.exp(-(sum(w[i] * x for i, x in value.items()) + wb))) - label
        for i, x in value.items():
            grad = g * x
            sigma = ((n.get(i, 0.0) + grad * grad) ** 0.5 - n.get(i, 0.0) ** 0.5) / classifier.ALPHA
            z[i] = z.get(i, 0.0) + grad - sigma * w[i]
            n[i] = n.get(i, 0.0) + grad * grad
        sigma = ((bias[1] + g * g) ** 0.5 - bias[1] ** 0.5) / classifier.ALPHA
        bias = [bias[0] + g - sigma * wb, bias[1] + g * g]
    weights, own = model.weights()
    assert np.allclose([weights[i] for i in z], [weight(z[i], n[i]) for i in z]) and np.isclose(own, weight(*bias, 0.0))
    assert np.count_nonzero(weights) <= len(z)


def test_equal_texts_get_equal_scores(documents):
    """Ties: rows that repeat a text, and texts without words, score alike whatever rows stand around them."""
    model = classifier.QualityModel(np.linspace(-1, 1, 1 << classifier.BITS), 0.1)
    rows = [(i, t) for i in range(3) for t in ("some words here", None, "", " \n", "x " * 5000)]
    found = classifier.score_quality(documents(rows).repartition(4), model, ["doc_id", "text"]).collect()
    by = {}
    for row in found:
        by.setdefault((row["text"] or "").strip(), set()).add(row["score"])
    assert len(found) == len(rows) and all(len(x) == 1 for x in by.values())


@pytest.mark.parametrize("seed", range(5))
def test_matcher_against_plain_loops(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randint(1, 4)))
    lexicon = sorted({word() + r.choice(["", "", "*"]) for _ in range(8)})
    exceptions = sorted({word() + " " + word() for _ in range(3)})
    matcher = toxicity.Matcher(lexicon, exceptions)
    entries = {e.rstrip("*"): (i, not e.endswith("*")) for i, e in enumerate(lexicon)}  # the last of two alike decides
    for _ in range(60):
        text = "".join(r.choice("abc  .") for _ in range(r.randint(0, 60)))
        alone = lambda low, high, whole: not (low and text[low - 1].isalnum()) and not (whole and text[high:high + 1].isalnum())
        spared = [(k, k + len(e)) for e in exceptions for k in range(len(text)) if text.startswith(e, k) and alone(k, k + len(e), True)]
        want = {}
        for k in range(len(text)):
            own = [(len(e), i) for e, (i, whole) in entries.items() if text.startswith(e, k) and alone(k, k + len(e), whole)]
            if own and not any(a <= k and k + max(own)[0] <= b for a, b in spared):
                want[max(own)[1]] = want.get(max(own)[1], 0) + 1
        assert matcher.count(text.encode()) == (len(text.split()), want)


def test_ids_of_joined_and_composed_words_are_those_of_the_library():
    """Words with marks, capitals, apostrophes, control characters and composed letters, alone and in texts."""
    encoder, r = packing.Tokenizer(packing.word_bpe()), random.Random(1)
    letters = "abcdeÉΣß,.'sS1٣中-\x00\x01" + "".join(map(chr, (0x301, 0xFB01, 0x1F600)))
    words = [w for w in ("".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(4000)) if w.split() == [w]]
    texts = ["", " \n", *words[:500], *(" ".join(r.choice(words) for _ in range(40)) for _ in range(300))]
    got = encoder.encode([t.encode() for t in texts])
    for text, ids in zip(texts, got):
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids, text
