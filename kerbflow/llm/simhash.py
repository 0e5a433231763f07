"""SimHash near-duplicates: fingerprints of word shingles, linked by a self-join of a binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kerbflow.llm.components import components
from kerbflow.llm.recurring import digest, settled
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import LOWER, map_texts, small_batches, under_plain_names
from kerbflow.llm.similar import alike_roots, majority, with_sets
from kerbflow.llm.trie import forest, trie_pairs
from kerbflow.session import discard, store

#: The query op7 has shingles of this many words and links by differing bits alone.
SHINGLE, SEED = 3, 42
MAX_BITS = 2
#: A fingerprint is cut into this many parts; two that differ in MAX_BITS bits agree in PARTS - MAX_BITS of them.
PARTS = 4
#: A key with more fingerprints than this is cut further, by parts of the bits that it leaves open.
HOT = 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the hashes of all shingles; as a signed number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    k = min(shingle, len(words))
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    starts = [0] + [e + 1 for e in ends]
    hashes = np.array([digest(view[s:e], SEED) for s, e in zip(starts, ends[k - 1:])], dtype="<u8")
    return majority(hashes)


def with_fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The `keep` columns and `fp`, the fingerprint as a long; zero for a null text and one without words."""
    return map_texts(docs, keep, text, lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]], "fp long")


def _keys(value: Column, low: int, high: int) -> Column:
    """For each choice of parts that may agree, the choice and the bits of the parts: an array of longs.

    `value` is cut into PARTS parts between the bits `low` and `high`; each key keeps PARTS - MAX_BITS of them.
    """
    from itertools import combinations

    width = (high - low) // PARTS
    keys = []
    for number, parts in enumerate(combinations(range(PARTS), PARTS - MAX_BITS)):
        mask = sum(((1 << width) - 1) << (low + p * width) for p in parts)
        keys.append(F.struct(F.lit(number).alias("choice"), value.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)).alias("bits")))
    return F.array(*keys)


def _open_bits(choice: int) -> list[int]:
    """The bits that a choice of parts leaves open, from low to high."""
    from itertools import combinations

    width = 64 // PARTS
    parts = list(combinations(range(PARTS), PARTS - MAX_BITS))[choice]
    return [b for p in range(PARTS) if p not in parts for b in range(p * width, (p + 1) * width)]


def _gathered(fp: Column, choice: Column) -> Column:
    """The open bits of a fingerprint moved together into the low bits, by its choice of parts."""
    from itertools import combinations

    width, out = 64 // PARTS, None
    for number, parts in enumerate(combinations(range(PARTS), PARTS - MAX_BITS)):
        open_parts = [p for p in range(PARTS) if p not in parts]
        value = F.lit(0).cast("long")
        for place, p in enumerate(open_parts):
            part = F.shiftrightunsigned(fp, p * width).bitwiseAND(F.lit((1 << width) - 1))
            value = value.bitwiseOR(F.shiftleft(part, place * width))
        out = F.when(choice == number, value) if out is None else out.when(choice == number, value)
    return out


def links(fingerprints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column `fp`, distinct) that connect all within MAX_BITS bits.

    Fingerprints are dealt out by parts in which a pair must agree, so that each group is small; where chance or a
    family of texts crowds one key, the bits that the key leaves open are cut the same way, which bounds a group by
    2**16 fingerprints. Inside a group the trie is joined with itself, and a spanning forest of the pairs is returned
    rather than all pairs.
    """
    dealt = fingerprints.select("fp", F.explode(_keys(F.col("fp"), 0, 64)).alias("k")).select("fp", "k.choice", "k.bits")
    crowded = dealt.groupBy("choice", "bits").count()
    # One row in HOT distinct fingerprints at most, but still a share of the data: the join decides by its true size.
    hot = store(crowded.where(F.col("count") > HOT).select("choice", "bits"), "hot-keys")
    several = store(crowded.where((F.col("count") > 1) & (F.col("count") <= HOT)).select("choice", "bits"), "shared-keys")
    group = F.xxhash64("choice", "bits")
    cold = dealt.join(several, ["choice", "bits"]).select("fp", "choice", "bits", F.lit(0).alias("finer"), F.lit(0).cast("long").alias("rest"))
    width = 64 // PARTS * MAX_BITS
    finer = (dealt.join(hot, ["choice", "bits"]).select("fp", "choice", "bits", F.explode(_keys(_gathered(F.col("fp"), F.col("choice")), 0, width)).alias("k"))
             .select("fp", "choice", "bits", (F.col("k.choice") + 1).alias("finer"), F.col("k.bits").alias("rest")))
    schema = "a long, b long"
    arrow = to_arrow_schema(fingerprints.sparkSession.createDataFrame([], schema).schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(table: pa.Table) -> pa.RecordBatch:
            values = table.column("fp").to_numpy().astype(np.uint64)
            keys = np.column_stack([table.column(c).to_numpy() for c in ("choice", "bits", "finer", "rest")])
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            a, b = [], []
            for own in np.split(values, cuts):
                if len(own) == 2:
                    if int(own[0] ^ own[1]).bit_count() <= MAX_BITS:
                        a.append(own[0])
                        b.append(own[1])
                elif len(own) > 2:
                    own = np.unique(own)
                    for i, j in forest(trie_pairs(own, MAX_BITS)):
                        a.append(own[i])
                        b.append(own[j])
            return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], schema=arrow)

        for batch in batches:
            # The last group of a batch may go on in the next one.
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            keys = np.column_stack([table.column(c).to_numpy() for c in ("choice", "bits", "finer", "rest")])
            other = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield edges(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield edges(pa.Table.from_batches(held))

    placed = cold.unionByName(finer).repartition(group, F.xxhash64("finer", "rest")).sortWithinPartitions("choice", "bits", "finer", "rest", "fp")
    return placed.mapInArrow(join, schema)


def _rows(docs: DataFrame, id_column: str, text: str, shingle: int, similarity: float | None) -> DataFrame:
    """(id, key, fp, node, ...) of every row; rows with one node are copies to the method."""
    keyed = docs.select(id_column, text, digest(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("key"))
    if similarity is not None:
        with small_batches(docs.sparkSession):
            return settled(with_sets(keyed, [id_column, "key"], text, shingle, similarity), "shingle-sets")
    return store(with_fingerprints(keyed, [id_column, "key"], text, shingle).withColumn("node", F.col("fp")), "fingerprints")


def _members(docs: DataFrame, id_column: str, text: str, shingle: int, similarity: float | None) -> tuple[DataFrame, DataFrame]:
    """(id, key, fp, node) of every row, and (node, root) of every node: the smallest node that links lead to."""
    rows = _rows(docs, id_column, text, shingle, similarity)
    nodes = store(rows.select("node").distinct(), "fingerprint-nodes")
    if similarity is None:
        roots = components(links(nodes.withColumnRenamed("node", "fp")))
    else:
        # What is told of a set is long; rows go on without it.
        wide, rows = rows, store(rows.select(id_column, "key", "fp", "node"), "set-names")
        sets = settled(wide.groupBy("node").agg(*(F.first(c).alias(c) for c in ("fp", "sketch", "size", "tokens"))), "distinct-sets")
        discard(wide)
        roots = alike_roots(docs, rows, sets, id_column, text, shingle, similarity)
    roots = roots.withColumnRenamed("node", "linked")
    return rows, store(nodes.join(roots, nodes.node == roots.linked, "left").select("node", F.coalesce("root", "node").alias("root")), "fingerprint-roots")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5,
                    similarity: float | None = 0.8) -> DataFrame:
    """(id, fp, component_id) of every row: texts whose sets of shingles have this Jaccard similarity are linked, links chained.

    Where `similarity` is None, fingerprints at MAX_BITS or fewer differing bits are linked instead, texts unseen.
    component_id is the smallest id in the component. Rows with equal sets (equal fingerprints) meet as one node before any
    join, so copies are never paired. Null and empty texts are copies of each other. A row without an id gets the component
    of its node, which is null if no row there has an id. Repeated rows give repeated rows.
    """
    rows, member = _members(docs, id_column, text, shingle, similarity)
    least = rows.groupBy("node").agg(F.min(id_column).alias("least")).join(member, "node").groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(least, "root").select("node", "component_id")
    return rows.join(named, "node").select(id_column, "fp", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5,
                similarity: float | None = 0.8) -> DataFrame:
    """All columns of one row of each component: the row with the smallest id (a null id comes first), then smallest digest.

    Components are those of near_duplicates. Of rows that repeat both id and text one stays. Texts meet the chosen ids once;
    only texts whose id and content are repeated take a further step.
    """
    docs, back = under_plain_names(docs, [id_column, text])
    rows, member = _members(docs, id_column, text, shingle, similarity)
    same = rows.groupBy(F.col(id_column).alias("id"), "key", "node").count()
    chosen = store(same.join(member, "node").groupBy("root").agg(F.min(F.struct("id", "key", F.col("count").alias("n"))).alias("m"))
                   .select("m.*"), "chosen")
    met = (docs.withColumn("_key", digest(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("d")
           .join(chosen.alias("c"), F.col(f"d.{id_column}").eqNullSafe(F.col("c.id")) & (F.col("d._key") == F.col("c.key"))))
    single = met.where("c.n = 1").select(*(F.col(f"d.`{c}`") for c in docs.columns))
    several = met.where("c.n > 1").groupBy("c.id", "c.key").agg(F.min_by(F.struct(*(F.col(f"d.`{c}`") for c in docs.columns)), F.to_json(
        F.struct(*(F.col(f"d.`{c}`") for c in docs.columns if c != text)))).alias("row")).select("row.*")
    return back(single.unionByName(several))


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE, similarity=None)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
