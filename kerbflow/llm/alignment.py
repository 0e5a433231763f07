"""Cross-tokenizer alignment: the token ends of two tokenizers are merged in independent pieces of equal work."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import pieces, texts
from kerbflow.session import scratch_dir, store

#: Ends that one piece of a merge takes in.
PIECE = 1 << 14
#: A pair of ids is one number, first id * SECOND + second id.
SECOND = 1 << 15
#: Chunks whose ids are remembered in a worker; beyond that the memory starts anew.
REMEMBERED = 800_000
#: So many id pairs (about 50 MB) are broadcast to the links at most; more pairs are joined by a shuffle.
BROADCAST_PAIRS = 1 << 20
#: White space, and what follows up to the next. Neither tokenizer joins a token across the start of a chunk.
CHUNK = re.compile("[ \n\t]+[^ \n\t]*")
#: Texts with other white space or separators, or with the mark that stands for a space, are encoded as a whole.
OTHER = re.compile("[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in (
    (0x00, 0x00), (0x0B, 0x0D), (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F),
    (0x2028, 0x202F), (0x205F, 0x2064), (0x2581, 0x2581), (0x3000, 0x3000), (0xFEFF, 0xFEFF), (0xFFFD, 0xFFFD))) + "]")
MARK = chr(0x2581)


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """The bytes of each token, and how a text becomes ids."""

    def __init__(self, tokens: list[bytes], encode: Callable[[str], list[int]]) -> None:
        self.tokens, self.encode = tokens, encode
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join([self.tokens[i] for i in ids]) == data


def byte_bpe(path: str) -> Vocabulary:
    """A byte-level vocabulary (library tokenizers); it encodes the text as it is."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    library, of = Tokenizer.from_file(path), byte_of_letter()
    library.encode_special_tokens = True
    names = sorted(library.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
    tokens = [bytes(of[c] for c in name) if all(c in of for c in name) else name.encode() for name, _ in names]
    return Vocabulary(tokens, lambda text: library.encode_batch_fast([text], add_special_tokens=False)[0].ids)


def piece_bpe(path: str) -> Vocabulary:
    """A vocabulary of pieces (library sentencepiece); it adds a space in front, so the text comes with its first space cut."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = [bytes([int(library.id_to_piece(i)[3:-1], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace(MARK, " ").encode()
              for i in range(library.get_piece_size())]
    return Vocabulary(tokens, lambda text: library.encode(text[1:], num_threads=1))


class Store:
    """Ids of remembered chunks, end to end."""

    def __init__(self) -> None:
        self.begin, self.size = array("q"), array("i")
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def put(self, ids: np.ndarray, cuts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.begin.frombytes((self.used + cuts[:-1]).astype(np.int64).tobytes())
        self.size.frombytes(np.diff(cuts).astype(np.int32).tobytes())
        self.used += len(ids)

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and how many each has."""
        begin, size = np.frombuffer(self.begin, np.int64)[codes], np.frombuffer(self.size, np.int32)[codes].astype(np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(begin - (ends - size), size)], size


class Encoder:
    """Ids of texts by both vocabularies; each distinct chunk is given to the libraries once, many joined together.

    A chunk at whose ends the tokens of the joined text do not end as well, or whose tokens do not spell it, is odd: a
    text that has it is encoded as a whole.
    """

    def __init__(self, first: Vocabulary, second: Vocabulary) -> None:
        self.both = first, second
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.stores = Store(), Store()
        self.odd = array("b")

    def _joined(self, chunks: list[str]) -> bool:
        """Remember the chunks, if the tokens of all of them together spell them and end where they end."""
        start = " a"
        data = (start + "".join(chunks)).encode()
        ends = np.cumsum([len(start), *(len(c.encode()) for c in chunks)])
        found = []
        for vocabulary in self.both:
            ids = vocabulary.encode(start + "".join(chunks))
            upto = np.cumsum(vocabulary.sizes[ids])
            cuts = np.searchsorted(upto, ends)
            if not vocabulary.spells(ids, data) or (upto[cuts] != ends).any():
                return False
            found.append((np.array(ids, np.int32)[cuts[0] + 1:], cuts - cuts[0]))
        for kept, (ids, cuts) in zip(self.stores, found):
            kept.put(ids, cuts)
        self.odd.extend([0] * len(chunks))
        return True

    def learn(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), 1000):
            part = chunks[at:at + 1000]
            if not self._joined(part):
                for chunk in part:
                    if not self._joined([chunk]):
                        for kept in self.stores:
                            kept.put(np.zeros(0, np.int32), np.zeros(2, np.int64))
                        self.odd.append(1)
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part))))

    def whole(self, text: str, data: bytes) -> list[np.ndarray]:
        """Ids of a text by the libraries themselves, or none where their tokens do not spell its bytes."""
        found = [v.encode(" " + text) for v in self.both]
        if not all(v.spells(ids, b" " + data) for v, ids in zip(self.both, found)):
            return [np.zeros(0, np.int32)] * 2
        return [np.array(ids, np.int32) for ids in found]

    def encode(self, batch: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vocabulary the ids of all texts one after another, and where each text begins; one more than texts."""
        if len(self.known) > REMEMBERED:
            self.clear()
        said = [t.decode("utf-8", "replace") for t in batch]
        split = [CHUNK.findall(" " + t) if t and not OTHER.search(t) else [] for t in said]
        chunks = [c for line in split for c in line]
        codes = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        if len(new := np.flatnonzero(codes < 0)):
            unknown = [chunks[i] for i in new.tolist()]
            self.learn(list(dict.fromkeys(unknown)))
            codes[new] = np.fromiter(map(self.known.__getitem__, unknown), np.int64, len(unknown))
        first = np.cumsum([0, *map(len, split)])
        odd = np.concatenate([[0], np.cumsum(np.frombuffer(self.odd, np.int8)[codes])]) if len(codes) else np.zeros(1, np.int64)
        apart = {i: self.whole(t, batch[i]) for i, t in enumerate(said) if t and (not split[i] or odd[first[i + 1]] > odd[first[i]])}
        out = []
        for k in range(2):
            flat, size = self.stores[k].take(codes)
            cuts = np.concatenate([[0], np.cumsum(size)])[first]
            if apart:
                parts = [apart[i][k] if i in apart else flat[cuts[i]:cuts[i + 1]] for i in range(len(said))]
                flat, cuts = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
            out.append((flat, cuts))
        return out


def merge_path(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of `piece` ends each begin in two sorted lists, as far as both are merged; an equal end of `a` comes first.

    For each diagonal a binary search finds how many of the merged ends before it are from `a`; all of them at once.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, diagonal - low
        middle = (low[open_] + high[open_]) // 2
        goes = a[middle] <= b[diagonal[open_] - 1 - middle]
        low[open_[goes]] = middle[goes] + 1
        high[open_[~goes]] = middle[~goes]


def overlaps(a: np.ndarray, b: np.ndarray, i: tuple[int, int], j: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one piece, tokens `i` of `a` and `j` of `b`: the overlapping tokens (two arrays of places), and the common ends.

    Between two ends that follow each other lies one token of either side, so each distinct end makes one link. An end of
    `b` that equals one of `a` is the same end, though a cut between pieces may fall between the two.
    """
    own_a, own_b = a[i[0]:i[1]], b[j[0]:j[1]]
    other = j[0] + np.searchsorted(b[j[0]:j[1] + 1], own_a)  # may be the first token of the next piece
    common = i[0] + np.flatnonzero(b[np.minimum(other, len(b) - 1)] == own_a)
    place = i[0] + np.searchsorted(a[i[0]:i[1] + 1], own_b)
    single = a[np.minimum(place, len(a) - 1)] != own_b
    if i[0] and len(own_b):
        single &= a[i[0] - 1] != own_b
    return np.concatenate([np.arange(*i), place[single]]), np.concatenate([other, np.arange(*j)[single]]), common


def digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all numbers up to `most` as rows of bytes with room for one more, and how many digits each has."""
    width = len(str(most))
    numbers = np.arange(most + 1)
    size = np.searchsorted(10 ** np.arange(1, width), numbers, side="right") + 1
    out = np.zeros((most + 1, width + 1), np.uint8)
    for place in range(width):
        shown = size > place
        out[shown, place] = 48 + numbers[shown] // 10 ** (size[shown] - 1 - place) % 10
    return out, size


class Aligner:
    """Merges the ends of all texts of a batch; their bounds are common ends."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.shown, self.width = digits(max(len(v.tokens) for v in encoder.both))

    def _written(self, a: np.ndarray, b: np.ndarray, common: np.ndarray, also: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes `a1,a2|b1;` of all groups, and where those of each token end; groups end with tokens `common` and `also`."""
        group_a = np.searchsorted(common, np.arange(len(a)))  # stitched over all pieces
        group_b = np.searchsorted(also, np.arange(len(b)))
        at_a = np.arange(len(a)) + np.append(0, also + 1)[group_a]
        at_b = np.arange(len(b)) + (common + 1)[group_b]
        ids, sign = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        sign[at_a[common]], sign[at_b[also]] = ord("|"), ord(";")
        width = self.width[ids]
        shown = self.shown[ids]
        shown[np.arange(len(ids)), width] = sign
        return shown[np.arange(shown.shape[1]) <= width[:, None]], np.cumsum(width + 1)

    def align(self, batch: list[bytes]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, groups text, pairs, times) of each text."""
        (a, first_a), (b, first_b) = self.encoder.encode(batch)
        end_a, end_b = (np.cumsum(v.sizes[ids]) for v, ids in zip(self.encoder.both, (a, b)))
        cut_a, cut_b = merge_path(end_a, end_b, PIECE)
        found = [overlaps(end_a, end_b, (i0, i1), (j0, j1)) for i0, i1, j0, j1 in
                 zip(cut_a[:-1].tolist(), cut_a[1:].tolist(), cut_b[:-1].tolist(), cut_b[1:].tolist())]
        left, right, common = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(3))
        also = np.searchsorted(end_b, end_a[common])
        row = np.searchsorted(first_a, left, side="right") - 1
        n_links = np.bincount(row, minlength=len(batch))
        n_groups = np.diff(np.searchsorted(common, first_a))
        pair = a[left].astype(np.int64) * SECOND + b[right]
        order = np.lexsort((pair, row))
        pair, row = pair[order], row[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        times, pair = np.diff(np.append(begin, len(pair))), pair[begin].astype(np.int32)
        bounds = np.searchsorted(row[begin], np.arange(len(batch) + 1))
        written, upto = self._written(a, b, common, also)
        upto = np.append(0, upto)[first_a + first_b].tolist()
        written = written.tobytes()
        out = []
        for k, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            groups = written[upto[k]:upto[k + 1] - 1] if upto[k + 1] > upto[k] else b""
            out.append((int(first_a[k + 1] - first_a[k]), int(first_b[k + 1] - first_b[k]), int(n_groups[k]), int(n_links[k]),
                        hashlib.sha256(groups).hexdigest() if groups else "", groups, pair[low:high], times[low:high].astype(np.int32)))
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def remembered(first: str, second: str) -> Aligner:
    """The aligner of this worker process, with the chunks that its earlier tasks have met."""
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(Encoder(byte_bpe(first), piece_bpe(second)))
    return _aligners[first, second]


def aligned_texts(docs: DataFrame, id_column: str, text: str, paths: Callable[[], tuple[str, str]], groups: bool = False) -> DataFrame:
    """Of every row its id, counts, digest and (if asked for) text of the groups; `pairs` are its distinct id pairs, `times` their links.

    `met` and `met_times` are the same over all rows of a piece of the task, on one row of it, so that corpus counts
    start from sums.
    """
    source = docs.select(F.col(id_column), F.col(text).cast("string").alias("_text"))
    shown = "groups string, " if groups else ""
    schema = T.StructType([source.schema[0], *T.StructType.fromDDL(
        f"n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {shown}pairs array<int>, times array<int>, "
        "met array<int>, met_times array<int>").fields])
    arrow = to_arrow_schema(schema)

    def lists(values: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
        sizes = [0 if v is None else len(v) for v in values]
        flat = np.concatenate([v for v in values if v is not None] or [np.zeros(0, np.int32)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.array(flat)).cast(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = remembered(*paths())
        for piece in pieces(batches, "_text"):
            found = aligner.align(texts(piece, "_text"))
            columns = list(zip(*found))
            pairs, times = columns[6], columns[7]
            met, place = np.unique(np.concatenate(pairs), return_inverse=True)
            sums = np.bincount(place, weights=np.concatenate(times), minlength=len(met)).astype(np.int32)
            rest = [np.zeros(0, np.int32)] * (len(found) - 1)
            arrays = [piece.column(0), *columns[:5], *([[g.decode() for g in columns[5]]] if groups else []),
                      lists(pairs, arrow.field("pairs").type), lists(times, arrow.field("times").type),
                      lists([met, *rest], arrow.field("met").type), lists([sums, *rest], arrow.field("met_times").type)]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                                              for x, f in zip(arrays, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair over the whole corpus, and whether no other pair of its second id has more."""
    counts = store(aligned.select(F.explode(F.arrays_zip("met", "met_times")).alias("m")).groupBy(F.col("m.met").alias("pair"))
                   .agg(F.sum("m.met_times").alias("n")), "pair-counts").withColumn("second", F.col("pair").bitwiseAND(F.lit(SECOND - 1)))
    most = counts.groupBy("second").agg(F.max("n").alias("most"))
    return counts.join(most, "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, paths: Callable[[], tuple[str, str]], id_column: str = "doc_id", text: str = "text",
                 groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row, and the groups as text if asked for.

    Space and text are encoded by a byte-level vocabulary (A) and by one of pieces (B); `paths` names both files on the
    executors. Where tokens of both end at the same byte, a group ends. Tokens that overlap are linked: n_links counts
    them, n_best those whose id pair no other pair of the same B id exceeds in the corpus, and count_sum adds up the
    corpus counts of the pairs. Texts that are null or empty, or that the tokens of A or B do not spell byte by byte,
    have no tokens: zeros and an empty digest. Repeated rows count each for itself, ids may be null or repeated, other
    columns are not read. A text is handled as a whole inside one task.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "aligned-texts")
    # The row number is fixed by being written.
    aligned_texts(docs, id_column, text, paths, groups).withColumn("_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    counts = store(pair_counts(aligned), "best-pairs")
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    links = aligned.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("_row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = (links.join(counts, "pair").groupBy("_row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (aligned.drop("pairs", "times", "met", "met_times").join(sums, "_row", "left")
            .select(id_column, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *(["groups"] if groups else [])))


def public_vocabularies() -> tuple[str, str]:
    """Where the public vocabulary files are on the machine that asks."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), public_vocabularies)
