"""Find, over a whole corpus, the stretches of text that can hold a passage of W units that stands in two places.

Units are words or bytes. Every window of W units has a gram of K units with the least hash; equal windows have equal
least grams. So a text is cut into stretches of windows with the same least gram, and only stretches whose gram turns up
again can hold a recurring window. The grams travel as numbers; of texts only the stretches that remain are moved, to
where all stretches of one gram meet. There the operators look for exact repeats.

Grams that very many different stretches share (both ends of a passage that stands in a third of all texts) are not sent
to one task. Their windows are counted by content with partial sums, which confirms the passages that recur; these are
dealt into shards of a bounded number, each shard meets its stretches in units of a bounded number, and the operators
locate the passages there. So no unit holds more than its share, however often a passage stands somewhere.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbflow.llm.blocks import block, mix, powers, sliding_min, word_hashes
from kerbflow.llm.rows import pieces
from kerbflow.session import discard, store

#: Stretches are handed to a search in lots of about this many bytes; those of one gram stay together.
LOT_BYTES = 1 << 19
#: Grams with more bytes of distinct stretches than this are resolved window by window.
HOT_BYTES = 1 << 21
#: Passages in a shard of a crowded gram, and stretches that meet them in one unit.
SHARD_PASSAGES, UNIT_STRETCHES = 4096, 4096

Search = Callable[[list[tuple[bytes, int]]], list[list[tuple[int, int]]]]


@dataclass(frozen=True)
class Units:
    """What a window is counted in."""

    window: int
    gram: int
    words: bool

    def hashes(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each unit, first unit of each row, and where each unit starts and ends in the bytes of its row."""
        if self.words:
            b = block(values)
            begin = np.repeat(b.offsets[:-1], b.counts())
            return word_hashes(b), b.first, b.starts - begin, b.ends - begin
        b = block(values)
        at = np.arange(len(b.data)) - np.repeat(b.offsets[:-1], np.diff(b.offsets))
        return mix(b.data.astype(np.uint64) + np.uint64(0x51ED270B0F3D5A11)), b.offsets, at, at + 1


def _gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of k units in a row, by doubling: few passes even for long grams."""
    have, out = 1, h
    step = powers(0xD6E8FEB86659FD93, 256)
    while have * 2 <= k:
        out = out[:-have] * step[have] + out[have:]
        have *= 2
    if have < k:  # two overlapping halves determine the gram
        rest = k - have
        out = out[:len(out) - rest] * step[have + 1] + out[rest:]
    return mix(out.copy() if out is h else out)


def stretches(values: pa.Array, units: Units) -> dict[str, np.ndarray]:
    """Stretches of windows with one least gram: row, gram, first window, windows, byte range, repeats inside."""
    h, first, start, end = units.hashes(values)
    w, k = units.window, units.gram
    n = len(h) - w + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return dict(row=empty, gram=empty, unit=empty, windows=empty, low=empty, high=empty, again=empty.astype(bool))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    g = _gram_hashes(h, k)
    least = sliding_min(g, w - k + 1)
    inside = row[:n] == row[w - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return dict(row=empty, gram=empty, unit=empty, windows=empty, low=empty, high=empty, again=empty.astype(bool))
    value, own = least[at], row[at]
    joined = np.zeros(len(at), bool)  # goes on from the window before
    joined[1:] = (at[1:] == at[:-1] + 1) & (value[1:] == value[:-1]) & (own[1:] == own[:-1])
    begin = np.flatnonzero(~joined)
    last = np.append(begin[1:], len(at)) - 1
    # The gram stands at the first unit of a window and again in the next one: only then can a stretch repeat itself.
    twice = np.zeros(len(at), bool)
    twice[:-1] = (g[at[:-1]] == value[:-1]) & joined[1:]
    return dict(row=own[begin], gram=value[begin].view(np.int64), unit=at[begin] - first[own[begin]], windows=last - begin + 1,
                low=start[at[begin]], high=end[at[last] + w - 1], again=np.logical_or.reduceat(twice, begin))


def digest(column: Column) -> Column:
    """Sixteen bytes that stand for the content of a text or a stretch."""
    return F.substring(F.unhex(F.sha2(column.cast("binary"), 256)), 1, 16)


def settled(df: DataFrame, name: str) -> DataFrame:
    """A stored step; shuffle files of the steps before it may go, and go at once rather than at some later collection."""
    out = store(df, name, compression="zstd")  # neighbouring stretches overlap
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def stretches_of(rows: DataFrame, units: Units) -> DataFrame:
    """(key, gram, unit, low, high, weight) of all stretches of rows (key, text)."""
    schema = "key binary, gram long, unit int, low int, high int, weight int"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            s = stretches(piece.column("text"), units)
            yield pa.RecordBatch.from_arrays([
                piece.column("key").take(pa.array(s["row"])), pa.array(s["gram"]), pa.array(s["unit"].astype(np.int32)),
                pa.array(s["low"].astype(np.int32)), pa.array(s["high"].astype(np.int32)), pa.array(1 + s["again"].astype(np.int32))],
                schema=arrow)

    return rows.select("key", "text").mapInArrow(cut, schema)


def candidates_of(rows: DataFrame, keys: DataFrame, units: Units) -> DataFrame:
    """Stored (key, copies, gram, unit, stretch, body): the stretches whose gram recurs, once per distinct text."""
    found = settled(stretches_of(rows, units), "stretches")
    often = found.groupBy("gram").agg(F.sum("weight").alias("n")).where("n > 1").select("gram")
    cuts = (found.join(often, "gram").groupBy("key").agg(F.collect_set(F.struct("gram", "unit", "low", "high")).alias("cuts"))
            .join(keys, "key"))
    met = rows.join(cuts, "key").where(F.col("id").eqNullSafe(F.col("least.id")))
    # One row per text: rows that repeat id and text are brought together, the others need no further step.
    single = met.where("least.n = 1").select("key", "copies", "text", "cuts")
    several = met.where("least.n > 1").groupBy("key", "copies").agg(F.min("text").alias("text"), F.first("cuts").alias("cuts"))
    cut_out = (single.unionByName(several).select("key", "copies", F.col("text").cast("binary").alias("text"), F.explode("cuts").alias("c"))
               .select("key", "copies", "c.gram", "c.unit", F.expr("substring(text, c.low + 1, c.high - c.low)").alias("body")))
    candidates = settled(cut_out.withColumn("stretch", digest(F.col("body"))), "candidates")
    discard(found)
    return candidates


def covered_stretches(candidates: DataFrame, units: Units, search: Search, windows: Callable[[bytes], list[bytes]]) -> tuple[DataFrame, list[DataFrame]]:
    """(gram, stretch, covered): unit ranges of each distinct stretch that recurring windows cover, in one row or several; and stored steps.

    `search` takes all stretches of a few groups, each with the number of places where it stands (two stands for more),
    and gives for each the covered ranges. `windows` lists the contents of the windows of a stretch.
    """
    distinct = settled(candidates.groupBy("gram", "stretch", "body").agg(F.sum(F.least("copies", F.lit(2))).alias("places")), "distinct-stretches")
    size = distinct.groupBy("gram").agg(F.sum(F.octet_length("body")).alias("size"))
    crowd = settled(size.where(F.col("size") > HOT_BYTES).select("gram", F.lit(True).alias("crowded")), "crowded-grams")
    marked = distinct.join(crowd, "gram", "left")
    few = marked.where("crowded is null").select(F.col("gram").alias("unit"), "gram", "stretch", "body", "places")
    crowded = marked.where("crowded").select("gram", "stretch", "body", "places")
    if crowd.isEmpty():
        return searched(few, search), [distinct, crowd]
    shards, steps = crowded_units(crowded, windows)
    return searched(few, search).unionByName(searched(shards, search)), [distinct, crowd, *steps]


def searched(rows: DataFrame, search: Search) -> DataFrame:
    """(gram, stretch, covered) of stretches (unit, gram, stretch, body, places); those of one unit are searched together.

    Rows without a stretch are passages: what equals one is covered, though it stands nowhere else in the unit.
    """
    schema = "gram long, stretch binary, covered array<struct<low:int,high:int>>"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def solved() -> pa.RecordBatch:
            found = search([(body, places) for *_, body, places in held])
            out = [(h[1], h[2], [{"low": x, "high": y} for x, y in c]) for h, c in zip(held, found, strict=True) if c and h[2] is not None]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], type=arrow.field(i).type) for i in range(3)], schema=arrow)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("unit", "gram", "stretch", "body", "places"))):
                if size > LOT_BYTES and row[0] != held[-1][0]:
                    yield solved()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solved()

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(lots, schema)


def crowded_units(crowded: DataFrame, windows: Callable[[bytes], list[bytes]]) -> tuple[DataFrame, list[DataFrame]]:
    """Rows for `searched`: the confirmed passages of crowded grams in shards, and the stretches that have one of them; and stored steps."""
    single = "gram long, stretch binary, places long, at int, content binary"
    arrow_single = to_arrow_schema(T.StructType.fromDDL(single))

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "body"):
            columns: list[list] = [[] for _ in arrow_single]
            for gram, stretch, body, places in zip(*(piece.column(c).to_pylist() for c in ("gram", "stretch", "body", "places"))):
                for at, content in enumerate(windows(body)):
                    for column, x in zip(columns, (gram, stretch, places, at, hashlib.sha256(content).digest()[:16]), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow_single)], schema=arrow_single)

    each = settled(crowded.mapInArrow(apart, single), "single-windows")
    # Equal windows have one gram, so passages are counted and dealt out inside it.
    again = settled(each.groupBy("gram", "content").agg(F.sum("places").alias("n"), F.min(F.struct("stretch", "at")).alias("first"))
                    .where("n > 1").select("gram", "content", "first"), "confirmed-passages")
    shards = again.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / SHARD_PASSAGES).alias("shards"))
    dealt = again.join(shards, "gram").select("gram", "content", "first", F.pmod(F.xxhash64("content"), "shards").alias("shard"))
    dealt = settled(dealt, "dealt-passages")
    routed = each.join(dealt.select("gram", "content", "shard"), ["gram", "content"]).select("gram", "shard", "stretch").distinct()
    salts = routed.groupBy("gram", "shard").agg(F.ceil(F.count(F.lit(1)) / UNIT_STRETCHES).alias("salts"))
    routed, salts = settled(routed, "routed-stretches"), settled(salts, "unit-numbers")
    unit = F.xxhash64("gram", "shard", "salt").alias("unit")  # two in one by chance do no harm
    located = (routed.join(salts, ["gram", "shard"]).withColumn("salt", F.pmod(F.xxhash64("stretch"), "salts"))
               .join(crowded, ["gram", "stretch"]).select(unit, "gram", "stretch", "body", "places"))

    passage = "gram long, shard long, body binary"
    arrow_passage = to_arrow_schema(T.StructType.fromDDL(passage))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "body"):
            rows = list(zip(*(piece.column(c).to_pylist() for c in ("gram", "shard", "body", "places_at"))))
            out = [(gram, shard, found[at]) for gram, shard, body, ats in rows for found in [windows(body)] for at in ats]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], type=arrow_passage.field(i).type) for i in range(3)], schema=arrow_passage)

    source = (dealt.groupBy("gram", "shard", F.col("first.stretch").alias("stretch")).agg(F.collect_list("first.at").alias("places_at"))
              .join(crowded, ["gram", "stretch"]).select("gram", "shard", "body", "places_at"))
    passages = (source.mapInArrow(cut, passage).join(salts, ["gram", "shard"])
                .select("gram", "shard", "body", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
                .select(unit, "gram", F.lit(None).cast("binary").alias("stretch"), "body", F.lit(1).cast("long").alias("places")))
    return located.unionByName(passages), [each, again, dealt, routed, salts]


def with_recurring(docs: DataFrame, id_column: str, text: str, units: Units, search: Search,
                   windows: Callable[[bytes], list[bytes]]) -> DataFrame:
    """All columns of `docs`, with `_runs`, the unit ranges that recurring windows cover, and `_whole`.

    `_whole` says that the same text stands on another row, so that every window of it recurs; `_runs` is null then.
    """
    keyed = docs.withColumn("_key", digest(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    rows = keyed.select(F.col("_key").alias("key"), F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    keys = (rows.groupBy("key", "id").count().groupBy("key")
            .agg(F.sum("count").alias("copies"), F.min(F.struct("id", F.col("count").alias("n"))).alias("least")))
    keys = settled(keys, "text-keys")
    candidates = candidates_of(rows, keys, units)
    covered, steps = covered_stretches(candidates, units, search, windows)
    runs = (candidates.where("copies = 1").select("key", "gram", "stretch", "unit").join(covered, ["gram", "stretch"])
            .groupBy("key").agg(F.flatten(F.collect_list(F.transform("covered", lambda c: F.struct(
                (c.low + F.col("unit")).alias("low"), (c.high + F.col("unit")).alias("high"))))).alias("_runs")))
    verdicts = settled(runs.select("key", "_runs", F.lit(False).alias("_whole")).unionByName(
        keys.where("copies > 1").select("key", F.lit(None).alias("_runs"), F.lit(True).alias("_whole"))), "covered")
    discard(keys, candidates, *steps)
    verdicts = verdicts.withColumnRenamed("key", "_match")
    return (keyed.join(verdicts, F.col("_key") == F.col("_match"), "left").drop("_key", "_match")
            .withColumn("_whole", F.coalesce("_whole", F.lit(False))))


def merged(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Ranges joined where they touch or overlap, in order."""
    out: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in runs or ()):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]
