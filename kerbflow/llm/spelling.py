"""Spelling variants: words one edit apart, met through whole one-edit neighbourhoods over a reduced alphabet."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbflow.llm.bits import bits_of, has
from kerbflow.llm.blocks import mix
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import LOWER, pieces, texts
from kerbflow.session import store

RUN = re.compile("[a-zÀ-ÿ]+")
#: A run loses a code point where this divides the checksum of its document and itself.
ONE_IN = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word is a variant of a near word that is so many times as frequent.
RATIO = 5
#: Words that a task counts before it hands them on.
HELD = 200_000
SYMBOLS = 4, 16
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: The filter of reduced words has 2 to the power of at most this many bits; a fuller one lets more through.
FILTER_POWER = 27
#: Neighbours that are made at a time.
BLOCK = 1 << 21


def counted_runs(rows: Iterable[tuple[str, bytes]], counts: dict[str, int]) -> None:
    """Add the runs of each (id, text), some of which lose a code point, to `counts`."""
    for name, text in rows:
        start = zlib.crc32(f"{name}:".encode())
        for run, n in Counter(RUN.findall(text.translate(LOWER).decode("utf-8", "replace"))).items():
            if len(run) < LEAST_LENGTH:
                continue
            h = zlib.crc32(run.encode(), start)
            if not h % ONE_IN:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < LEAST_LENGTH:
                    continue
            counts[run] = counts.get(run, 0) + n


def vocabulary(docs: DataFrame, id_column: str, text: str, least_count: int) -> DataFrame:
    """(word, n) of all words of LEAST_LENGTH code points or more that occur `least_count` times; tasks send sums."""
    schema = "word string, n long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=arrow)

        for piece in pieces(batches, "_text"):
            counted_runs(zip(piece.column("_id").to_pylist(), texts(piece, "_text")), counts)
            if len(counts) > HELD:
                yield handed_on()
                counts = {}
        if counts:
            yield handed_on()

    source = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"), F.col(text).cast("string").alias("_text"))
    return source.mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def symbols_for(words: int) -> int:
    """So many symbols that even the shortest words have about as many reduced forms as there are words."""
    return int(min(max(math.ceil(max(words, 1) ** (1 / LEAST_LENGTH)), SYMBOLS[0]), SYMBOLS[1]))


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """Words of one length as rows of symbols 1, 2, ...: a letter's symbol is a hash of it."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    return mix(letters.astype(np.uint64) * BASE) % np.uint64(symbols) + np.uint64(1)


def _scales(length: int) -> np.ndarray:
    out = np.full(length + 1, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def codes(digits: np.ndarray) -> np.ndarray:
    """One number for each row of symbols."""
    return mix((digits * _scales(digits.shape[1])[:-1]).sum(axis=1, dtype=np.uint64))


def neighbourhoods(digits: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, code) of each row of symbols and of all that one deletion, replacement or insertion makes of it.

    Each result comes once for a row: of equal symbols that follow each other the first is deleted, and none is inserted
    before its equal. Made a bounded number at a time, over positions where rows are long.
    """
    rows, length = digits.shape
    scale = _scales(length + 1)
    upto = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(digits * scale[:length], axis=1, out=upto[:, 1:])
    whole = upto[:, -1:]
    yield np.arange(rows), mix(whole[:, 0].copy())
    step = max(1, BLOCK // (rows * symbols))
    for low in range(0, length + 1, step):
        high = min(low + step, length)
        at = np.arange(low, high)
        own = digits[:, low:high]
        if len(at):
            fresh = np.ones(own.shape, bool)
            fresh[:, 1 if low == 0 else 0:] = own[:, 1 if low == 0 else 0:] != digits[:, max(low - 1, 0):high - 1]
            row, place = np.nonzero(fresh)
            yield row, mix((upto[:, low:high] + (whole - upto[:, low + 1:high + 1]) * UNBASE)[row, place])
            for symbol in range(1, symbols + 1):
                row, place = np.nonzero(own != symbol)
                yield row, mix((whole + (np.uint64(symbol) - own) * scale[at])[row, place])
        at = np.arange(low, min(low + step, length + 1))
        before = upto[:, at]
        for symbol in range(1, symbols + 1):
            new = np.ones((rows, len(at)), bool)
            new[:, :high - low] = own != symbol
            row, place = np.nonzero(new)
            yield row, mix((before + np.uint64(symbol) * scale[at] + (whole - before) * BASE)[row, place])


def by_length(words: list[str], most: int) -> Iterator[list[int]]:
    """Places of words of one length, with at most `most` letters together, or one word."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for length, own in places.items():
        step = max(1, most // max(length, 1))
        yield from (own[i:i + step] for i in range(0, len(own), step))


def with_codes(words: DataFrame, symbols: int) -> DataFrame:
    """`code` of the reduced word added to (word, n)."""
    schema = "word string, n long, code long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, out = batch.column("word").to_pylist(), np.zeros(batch.num_rows, np.uint64)
            for own in by_length(found, BLOCK):
                out[own] = codes(reduced([found[i] for i in own], symbols))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column("n").cast(pa.int64()), pa.array(out.view(np.int64))], schema=arrow)

    return words.select("word", "n").mapInArrow(add, schema)


def neighbour_codes(forms: DataFrame, symbols: int, power: int) -> DataFrame:
    """(code, other): reduced words whose neighbourhood has a reduced word of the vocabulary, itself included.

    `forms` has one word for each code. Neighbours that the filter excludes are in no vocabulary; codes that are equal by
    chance fall to the check of the words.
    """
    bits = forms.sparkSession.sparkContext.broadcast(bits_of(forms, "code", power))
    schema = "code long, other long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in batches:
            words, own = batch.column("word").to_pylist(), batch.column("code").to_numpy()
            for places in by_length(words, BLOCK // 64):
                named = own[places]
                for row, code in neighbourhoods(reduced([words[i] for i in places], symbols), symbols):
                    there = has(known, code, power)
                    if there.any():
                        yield pa.RecordBatch.from_arrays([pa.array(named[row[there]]), pa.array(code[there].view(np.int64))], schema=arrow)

    return forms.mapInArrow(spread, schema)


def near_words(words: DataFrame, symbols: int, power: int) -> DataFrame:
    """(word, n, near, near_n) of all ordered pairs of words that one edit separates; `words` is a stored (word, n, code)."""
    forms = words.groupBy("code").agg(F.min("word").alias("word"))
    met = store(neighbour_codes(store(forms, "reduced-words"), symbols, power), "reduced-neighbours")
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("code").alias("other"))
    # A second code equal by chance could bring a pair twice; pairs of codes are distinct, so pairs of words are.
    return (met.distinct().join(words, "code").join(other, "other")
            .where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): where (word, form) leads, by doubling. A form is RATIO times as frequent, so `most` bounds the steps."""
    steps = max(1, math.ceil(math.log(max(most, RATIO) / LEAST_COUNT, RATIO)))
    out = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        out = store(out, "roots")
        ahead = out.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        out = out.join(ahead, out.root == ahead._word, "left").select("word", F.coalesce("_root", "root").alias("root"))
    return out


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT,
                      symbols: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts that has six code points and `least_count` occurrences.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF in lower case (only A-Z are changed); a run loses a code
    point where 199 divides the CRC-32 of id, colon and run (a null id is written as nothing). Near words differ by one
    inserted, deleted or replaced code point. A word's form is its most frequent near word (ties: the first by code
    point), if that is five times as frequent, and null otherwise; `root` follows forms to the last. Null and empty texts
    have no words, repeated rows count as often as they stand there, other columns are not read.

    Letters are hashed to a few symbols (by default chosen by the size of the vocabulary). Each reduced word makes its
    whole one-edit neighbourhood; those in the reduced vocabulary meet there, and pairs are verified on the words.
    """
    counted = store(vocabulary(docs, id_column, text, least_count), "words")
    total, most = counted.agg(F.count("*"), F.max("n")).first()
    few = symbols or symbols_for(total)
    words = store(with_codes(counted, few), "coded-words")
    power = min(max(16, (8 * max(total, 1)).bit_length()), FILTER_POWER)
    near = near_words(words, few, power)
    best = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    frequent = -F.col("best.less") >= RATIO * F.col("n")
    named = store(best.select("word", "n_near", F.when(frequent, F.col("best.near")).alias("form"),
                              F.when(frequent, -F.col("best.less")).alias("form_n")), "near-words")
    led = roots(named.where("form is not null").select("word", "form"), most or 0)
    return (counted.join(named, "word", "left").join(led, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
