"""Token alignment against a plain walk over the tokens that the libraries give for whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from kerbflow.llm import alignment

LETTERS = "abcdefg ABC\n\t  .,;'é中\r\xa0\x1c<>|0123\x85" + "".join(map(chr, (0x2581, 0x200B, 0x3000, 0x1F600)))
TEXTS = ["", None, "a", " ", "  two  spaces  ", "\n\nlines\n \n x", "tab\tand\n newline ", "mixed \n  a", "<|endoftext|> stays <s> text </s>", "it's we'll 'S",
         "mark " + alignment.MARK + " here", "null \x00 byte", "café naïve Ærøskøbing", "emoji " + "".join(map(chr, (0x1F600, 0x1F468, 0x200D, 0x1F469))), "long" * 3000, "x\r\ny;\r z", "0x0A 123456 ...!!",
         "word " * 2000, chr(0xFB01) + " ligature e" + chr(0x301), chr(0xFEFF) + "bom", "nb\xa0space", "\n", "\t\t x", "a" + " " * 40 + "b"]


def texts(seed, n):
    r = random.Random(seed)
    plain = [c for c in LETTERS if not alignment.OTHER.match(c)]
    return TEXTS + ["".join(r.choice(plain if r.random() < 0.7 else LETTERS) for _ in range(r.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = alignment.public_vocabularies()
    a, b = Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
    a.encode_special_tokens = True
    of = alignment.byte_of_letter()

    def encode(text):
        x = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(alignment.MARK, " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
        want = (" " + text).encode()
        return (x, y) if text and b"".join(t for _, t in x) == want == b"".join(t for _, t in y) else ([], [])
    return encode


def brute(found, encode):
    """Rows of the result for a list of texts, and the groups."""
    rows, counts = [], Counter()
    for text in found:
        a, b = encode(text or "")
        spans = [[], []]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, t in tokens:
                spans[side].append((at, at + len(t), i))
                at += len(t)
        links, j = [], 0
        for low, high, i in spans[0]:
            while spans[1][j][1] <= low:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < high:
                links.append((i, spans[1][k][2]))
                k += 1
        cuts = sorted({h for _, h, _ in spans[0]} & {h for _, h, _ in spans[1]})
        groups = [defaultdict(list), defaultdict(list)]
        for side in range(2):
            for _, high, i in spans[side]:
                groups[side][next(c for c in cuts if c >= high) if len(cuts) < 400 else cuts[np.searchsorted(cuts, high)]].append(str(i))
        counts.update(links)
        rows.append((len(a), len(b), links, ";".join(",".join(groups[0][c]) + "|" + ",".join(groups[1][c]) for c in cuts), len(cuts)))
    most = Counter()
    for (_, second), n in counts.items():
        most[second] = max(most[second], n)
    return [(n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for n_a, n_b, links, g, n in rows], [r[3] for r in rows]


@pytest.mark.parametrize("seed,pairs,piece", [(1, 1 << 20, 1 << 14), (2, 0, 7)])
def test_rows_of_all_kinds_of_texts(spark, documents, libraries, monkeypatch, seed, pairs, piece):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", pairs)
    monkeypatch.setattr(alignment, "PIECE", piece)
    found = texts(seed, 300)
    rows, groups = brute(found, libraries)
    docs = documents([(i // 2 if i % 7 else None, t) for i, t in enumerate(found)]).coalesce(1)
    out = alignment.align_tokens(docs, alignment.public_vocabularies, groups=True)
    want = sorted(str((i // 2 if i % 7 else None, *r, g)) for i, (r, g) in enumerate(zip(rows, groups)))
    assert sorted(str(tuple(r)) for r in out.collect()) == want


def test_ids_are_those_of_the_libraries_on_whole_texts(spark, libraries):
    aligner = alignment.remembered(*alignment.public_vocabularies())
    found = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + texts(3, 2000)
    (a, first_a), (b, first_b) = aligner.encoder.encode([(t or "").encode() for t in found])
    for k, text in enumerate(found):
        x, y = libraries(text or "")
        assert a[first_a[k]:first_a[k + 1]].tolist() == [i for i, _ in x] and b[first_b[k]:first_b[k + 1]].tolist() == [i for i, _ in y], text


@pytest.mark.parametrize("piece", [1, 2, 5, 100])
def test_pieces_of_a_merge_give_what_the_whole_gives(piece):
    r = np.random.default_rng(piece)
    for n in (0, 1, 3, 50):
        total = 4 * n + 1
        a, b = (np.append(np.sort(r.choice(np.arange(1, total), size=r.integers(0, n + 1) if n else 0, replace=False)), total) for _ in range(2))
        cut_a, cut_b = alignment.merge_path(a, b, piece)
        assert (np.diff(cut_a) + np.diff(cut_b) <= piece).all() and cut_a[-1] == len(a) and cut_b[-1] == len(b)
        links, common = [], []
        for i0, i1, j0, j1 in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:]):
            left, right, ends = alignment.overlaps(a, b, (i0, i1), (j0, j1))
            links += zip(left.tolist(), right.tolist())
            common += a[ends].tolist()
        low_a, low_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if low_a[i] < b[j] and low_b[j] < a[i]]
        assert sorted(links) == want and common == sorted(set(a.tolist()) & set(b.tolist()))


def test_no_documents(documents):
    assert alignment.align_tokens(documents([]), alignment.public_vocabularies).count() == 0
