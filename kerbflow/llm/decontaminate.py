"""Benchmark decontamination by winnowing: shared least grams are joined and extended to exact windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.blocks import ALNUM, FOLD, block, grams, sliding_min, word_hashes
from kerbflow.llm.recurring import digest
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import FOLD_WORDS, map_texts
from kerbflow.session import store

#: Words in a window, and in the grams of which the one with the least hash stands for the window.
WINDOW, GRAM = 10, 5
#: Bits of the filter that is sent to all tasks: one megabyte, whatever the size of the benchmark.
FILTER_BITS = 23


def window_marks(texts: list[bytes], lengths: tuple[int, ...]) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
    """Words per text; for each window length, first words (over all texts) and marks of the windows; first word per text.

    The mark of a full window is the least hash of its grams, so two equal windows have equal marks wherever they stand.
    Shorter windows, for whole items of fewer words, are marked by the hash of all their words.
    """
    b = block(pa.array(texts, pa.large_binary()), ALNUM)
    h, row, out = word_hashes(b, FOLD), b.row_of_word(), []
    for length in lengths:
        n = max(0, len(h) - length + 1)
        marks = sliding_min(grams(h, GRAM), WINDOW - GRAM + 1) if length == WINDOW else grams(h, length)
        at = np.flatnonzero(row[:n] == row[length - 1:length - 1 + n])
        out.append((length, at, marks[at].view(np.int64)))
    return b.counts(), out, b.first


def marked_windows(rows: DataFrame, keep: list[str], text: str, lengths: tuple[int, ...], bits: np.ndarray | None) -> DataFrame:
    """The `keep` columns, n_words, and the windows of each text that pass the filter: mark, first word, words, content.

    Without a filter a text gives the windows that an item has: all full ones, or one of all its words if it has fewer.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def make():
        def derive(texts):
            counts, found, first = window_marks(texts, lengths)
            known = shared.value
            windows: list[list[dict]] = [[] for _ in texts]
            words: dict[int, list[bytes]] = {}
            for length, at, marks in found:
                if known is None:
                    own = np.searchsorted(first, at, side="right") - 1
                    chosen = counts[own] >= WINDOW if length == WINDOW else counts[own] == length
                else:
                    bit = marks.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
                    chosen = known[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1
                at, marks = at[chosen], marks[chosen]
                owner = np.searchsorted(first, at, side="right") - 1
                for i, place, mark in zip(owner.tolist(), (at - first[owner]).tolist(), marks.tolist()):
                    if i not in words:
                        words[i] = texts[i].translate(FOLD_WORDS).split()
                    windows[i].append({"mark": mark, "at": place, "size": length, "content": b" ".join(words[i][place:place + length])})
            return [counts.tolist(), windows]
        return derive

    return map_texts(rows, keep, text, make, "n_words long, windows array<struct<mark:long,at:int,size:int,content:binary>>")


def filter_of(marks: DataFrame) -> np.ndarray:
    """A bit for each low part of a mark that occurs: at most 2**17 rows of 64 bits come to the driver."""
    low = marks.select(F.col("mark").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("b"))
    rows = low.groupBy(F.shiftright("b", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), "<i8")
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """(id, key, n_words, n_hit, items) of every row: its words inside windows of benchmark items, and those items' ids.

    A window is ten words in a row of an item, or all words of an item with fewer. Each occurrence is found: equal
    windows have equal marks, the filter lets every mark of an item through, and marks that pass are joined and compared
    word by word. Null and empty texts have no words. Items without words match nothing; one without an id marks words
    but is not listed. Repeated rows and items change nothing; `key` stands for the content of a text.
    """
    parts = marked_windows(items, [item_id], item_text, tuple(range(1, WINDOW + 1)), None)
    of_items = store(parts.select(F.col(item_id).cast("string").alias("item"), F.explode("windows").alias("w"))
                     .select("item", "w.mark", "w.size", "w.content").distinct(), "item-windows")
    lengths = tuple(sorted(r.size for r in of_items.select("size").distinct().collect()))  # ten rows at most
    keyed = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")).withColumn(
        "key", digest(F.coalesce("text", F.lit(""))))
    rows = store(marked_windows(keyed, ["id", "key"], "text", lengths, filter_of(of_items)), "marked-windows")
    passed = rows.where(F.size("windows") > 0).select("key", F.explode("windows").alias("w")).select(
        "key", "w.mark", "w.at", "w.size", "w.content").distinct()
    known = of_items.select("mark", "content").distinct()
    hits = store(passed.join(known, ["mark", "content"]), "window-hits")
    reach = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct((s.n + F.greatest(F.lit(0).cast("long"), x.at + x.size - F.greatest(s.end, x.at.cast("long")))).alias("n"),
                              F.greatest(s.end, (x.at + x.size).cast("long")).alias("end")))
    covered = hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans")).select("key", reach.n.alias("n_hit"))
    named = (hits.select("key", "mark", "content").distinct().join(of_items.where("item is not null"), ["mark", "content"])
             .select("key", "item").distinct().groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    found = covered.join(named, "key", "left")
    return rows.select("id", "key", "n_words").join(found, "key", "left").select(
        F.col("id").alias(id_column), "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


WORDS_SQL = r"""coalesce(regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::varchar[])"""

OP2_SQL = f"""
with d as (select doc_id, {WORDS_SQL.format(text="text")} w from documents),
i as (select item_id, {WORDS_SQL.format(text="text")} w from benchmark),
iw as (select distinct cast(item_id as varchar) item, array_to_string(w[a:a + least(len(w), 10) - 1], ' ') win, least(len(w), 10) size
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) a from i where len(w) > 0)),
dw as (select doc_id, size, a, array_to_string(w[a:a + size - 1], ' ') win
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) a from d, (select distinct size from iw))),
h as (select doc_id, a, size, win from dw semi join iw using (win)),
n as (select doc_id, count(*) n_hit from (select distinct doc_id, unnest(range(a, a + size)) p from h) group by doc_id),
t as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct doc_id, item from h join iw using (win)) group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""


@query("op2_decontamination", OP2_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
