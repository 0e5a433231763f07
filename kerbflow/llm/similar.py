"""Texts whose sets of word shingles are alike by Jaccard similarity: a trie of fingerprints by shared shingle, then the rest, each link confirmed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kerbflow.llm.bits import bits_of, has
from kerbflow.llm.blocks import block, grams, word_hashes
from kerbflow.llm.components import components
from kerbflow.llm.recurring import digest, settled
from kerbflow.llm.rows import LOWER, map_texts, small_batches
from kerbflow.llm.trie import forest, trie_pairs
from kerbflow.session import discard, store

FOLD = np.frombuffer(LOWER, np.uint8)
#: A sketch counts the shingles of a set in so many classes, up to FULL.
CLASSES, FULL = 64, 255
#: Its tokens that recur are counted in so many.
MARKS = 32
#: Shingles that several texts of a sample share come last in the order of shingles; kept as a filter of 2 to the power of so many bits.
COMMON_POWER = 24
SAMPLE, COMMON = 16, 3
#: The filter of tokens that recur has 2 to the power of so many bits; a fuller one lets more through, which a join takes out.
RECURRING_POWER = 26
#: A set brings about this many of its tokens along at most: those of one of its parts.
PART = 64
#: With the sign turned, signed numbers are in the order of the fingerprints' bits.
SIGN = np.uint64(1 << 63)
#: Fingerprints that share a token join the trie at so many bits; alike pairs further apart are found among all other pairs.
WIDE_BITS = 16
#: More fingerprints than this under one token are linked by hubs; so many pairs are held by a task at once, and so many tokens of pairs.
HOT, LOT, HELD = 256, 1 << 18, 1 << 20
#: Sets meet the likeliest set of another group again while at least this share of such pairs is alike.
AGAIN = 0.25


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of 64-bit hashes have; as a signed number, zero without hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def shingle_sets(found: list[bytes], shingle: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text; one of fewer words is a shingle as a whole."""
    b = block(pa.array(found, pa.large_binary()))
    h = word_hashes(b, FOLD)
    return [np.unique(grams(h[i:j], min(shingle, j - i))) if j > i else h[:0] for i, j in zip(b.first[:-1].tolist(), b.first[1:].tolist())]


def node(own: np.ndarray) -> int:
    """A signed number that stands for a set."""
    value = xxhash.xxh64_intdigest(own.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


def least_common(size: int, similarity: float) -> int:
    """Members that two alike sets share at least, if one has this size."""
    return int(np.ceil(similarity * size - 1e-9))


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    if min(len(a), len(b)) < least_common(max(len(a), len(b)), similarity):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def common_shingles(docs: DataFrame, text: str, shingle: int) -> np.ndarray:
    """Bits of shingles that COMMON texts of a sample have. It only orders shingles: results are the same for any bits."""
    part = docs.where(F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(SAMPLE)) == 0)
    sets = map_texts(part, [], text, lambda: lambda found: [[s.view(np.int64) for s in shingle_sets(found, shingle)]], "shingles array<long>")
    counted = sets.select(F.explode("shingles").alias("s")).groupBy("s").count().where(F.col("count") >= COMMON)
    return bits_of(counted, "s", COMMON_POWER)


def with_sets(docs: DataFrame, keep: list[str], text: str, shingle: int, similarity: float) -> DataFrame:
    """The `keep` columns; `node` stands for the set, `fp` is its fingerprint, `sketch` its counts by class, `size` its size.

    `tokens` are the first shingles of the set in an order of all shingles, so many that two alike sets have one of them
    in common: all but what they share at least, and one.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text, shingle))

    def derive(found: list[bytes]) -> list[list]:
        sets, tokens = shingle_sets(found, shingle), []
        for own in sets:
            late = has(common.value, own, COMMON_POWER)
            tokens.append(np.concatenate([own[~late], own[late]])[:len(own) - least_common(len(own), similarity) + 1].view(np.int64))
        return [[node(own) for own in sets], [majority(own) for own in sets], [sketch(own) for own in sets], [len(own) for own in sets], tokens]

    return map_texts(docs, keep, text, lambda: derive, "node long, fp long, sketch binary, size int, tokens array<long>")


def sketch(own: np.ndarray) -> bytes:
    """How many shingles of a set fall in each class. What two sets share is at most the sum of the lesser counts."""
    return np.minimum(np.bincount((own >> np.uint64(32)).astype(np.int64) % CLASSES, minlength=CLASSES), FULL).astype(np.uint8).tobytes()


def marks(owner: np.ndarray, tokens: np.ndarray, rows: int) -> np.ndarray:
    """How many of its tokens that recur fall in each of MARKS classes, up to FULL, for each set: a token is one of the set at `owner`."""
    place = owner * MARKS + (tokens >> np.uint64(32)).astype(np.int64) % MARKS
    return np.minimum(np.bincount(place, minlength=rows * MARKS), FULL).astype(np.uint8).reshape(rows, MARKS)


def possible(sketches: np.ndarray, sizes: np.ndarray, one: np.ndarray, size: int, similarity: float) -> np.ndarray:
    """Which sets may have the similarity to one, by sizes and sketches; none that has it is left out."""
    shared = np.minimum(sketches, one).sum(axis=1, dtype=np.int64)
    open_ = (sketches == FULL).any(axis=1) | (one == FULL).any()
    enough = open_ | (shared * (1 + similarity) >= similarity * (sizes + size) - 1e-6)
    return enough & (np.minimum(sizes, size) >= similarity * np.maximum(sizes, size) - 1e-9)


def _near(nodes: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Edges that connect what chains of pairs connect whose sizes and sketches allow for the similarity."""
    while len(nodes) > 1:
        todo = [(nodes[0], sketches[0], sizes[0])]
        nodes, sketches, sizes = nodes[1:], sketches[1:], sizes[1:]
        while todo and len(nodes):
            one, counts, size = todo.pop()
            near = possible(sketches, sizes, counts, size, similarity)
            if near.any():
                yield from ((one, other) for other in nodes[near])
                todo += zip(nodes[near], sketches[near], sizes[near])
                nodes, sketches, sizes = nodes[~near], sketches[~near], sizes[~near]


def least_shared(one: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """How many tokens two alike sets of these sizes share at least.

    What they share beyond their common tokens comes, in the order of shingles, after the tokens of the one whose tokens end
    first, so it is less than `least_common` of its size.
    """
    common = np.ceil(similarity * (one + other) / (1 + similarity) - 1e-6)
    return np.maximum(common - np.ceil(similarity * np.maximum(one, other) - 1e-9) + 1, 1).astype(np.int64)


def likely(counts: tuple[np.ndarray, np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of places (i, j) sizes, sketches and marks (`counts`) leave open, and a number that grows with the similarity they may have."""
    sizes, sketches, marked = counts
    shared = np.minimum(sketches[i], sketches[j]).sum(axis=1, dtype=np.int64)
    full = (sketches[i] == FULL).any(axis=1) | (sketches[j] == FULL).any(axis=1)
    both = sizes[i] + sizes[j]
    stay = np.flatnonzero((full | (shared * (1 + similarity) >= similarity * both - 1e-6)) & (
        np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j]) - 1e-9))
    a, b = i[stay], j[stay]
    tokens = np.minimum(marked[a], marked[b]).sum(axis=1, dtype=np.int64)
    full = (marked[a] == FULL).any(axis=1) | (marked[b] == FULL).any(axis=1)
    stay = stay[full | (tokens >= least_shared(sizes[a], sizes[b], similarity))]
    return stay, shared[stay] / np.maximum(both[stay], 1)


def _trie_links(token: np.ndarray, nodes: np.ndarray, counts: tuple[np.ndarray, np.ndarray, np.ndarray], order: np.ndarray, cuts: np.ndarray,
                similarity: float) -> np.ndarray:
    """Places (i, j) that connect the sets of one token whose fingerprints differ in at most WIDE_BITS bits; `order` is sorted in a group.

    The likeliest pairs connect them, so that much the same pairs come from all tokens of a family.
    """
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (order[1:] != order[:-1])
    first = np.flatnonzero(new)
    equal = np.flatnonzero(~new)
    alone = np.column_stack([first[np.searchsorted(first, equal, "right") - 1], equal])
    sizes, sketches, _ = counts
    found = [alone[likely(counts, alone[:, 0], alone[:, 1], similarity)[0]]]
    ends = np.searchsorted(first, cuts)
    crowded = np.flatnonzero(np.diff(ends) > HOT)
    # In a crowded group most pairs are near, so there the hubs of `_near` stand for them.
    for g in crowded.tolist():
        own = first[ends[g]:ends[g + 1]]
        found.append(np.array([(int(a), int(b)) for a, b in _near(own, sketches[own], sizes[own], similarity)], np.int64).reshape(-1, 2))
    quiet = np.repeat(np.diff(ends) <= HOT, np.diff(ends))
    kept, lengths = first[quiet], np.diff(ends)[np.diff(ends) <= HOT]
    pairs = kept[trie_pairs(order[kept], WIDE_BITS, cuts=np.concatenate([[0], np.cumsum(lengths)]))].reshape(-1, 2)
    stay, score = likely(counts, pairs[:, 0], pairs[:, 1], similarity)
    pairs = pairs[stay]
    found.append(np.array(forest(pairs[np.lexsort((nodes[pairs[:, 1]], nodes[pairs[:, 0]], -score))]), np.int64).reshape(-1, 2))
    return np.concatenate(found)


def _open_pairs(label: np.ndarray, counts: tuple[np.ndarray, np.ndarray, np.ndarray], cuts: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All places i and j in one group with different labels that `likely` leaves open, and how likely; one distance after the other."""
    end = np.repeat(cuts[1:], np.diff(cuts))
    here = np.arange(len(label))
    for apart in range(1, int(np.diff(cuts).max(initial=0))):
        here = here[here + apart < end[here]]
        i = here[label[here] != label[here + apart]]
        stay, score = likely(counts, i, i + apart, similarity)
        yield i[stay], i[stay] + apart, score


def _best_pairs(label: np.ndarray, counts: tuple[np.ndarray, np.ndarray, np.ndarray], cuts: np.ndarray, similarity: float) -> np.ndarray:
    """For each place the likeliest open one of its group with another label, as places (i, j): at most one pair a place."""
    best, partner = np.full(len(label), -1.0), np.full(len(label), -1)
    for i, j, score in _open_pairs(label, counts, cuts, similarity):
        for own, other in ((i, j), (j, i)):
            better = score > best[own]
            best[own[better]], partner[own[better]] = score[better], other[better]
    own = np.flatnonzero(partner >= 0)
    return np.column_stack([own, partner[own]])


def _other_pairs(label: np.ndarray, counts: tuple[np.ndarray, np.ndarray, np.ndarray], cuts: np.ndarray, similarity: float) -> Iterator[np.ndarray]:
    """All open places (i, j) in one group with different labels, a bounded lot at a time."""
    lot, held = [], 0
    for i, j, _ in _open_pairs(label, counts, cuts, similarity):
        lot.append(np.column_stack([i, j]))
        held += len(i)
        if held > LOT:
            yield np.concatenate(lot)
            lot, held = [], 0
    if held:
        yield np.concatenate(lot)


def part_count(tokens: np.ndarray) -> np.ndarray:
    """Into how many parts a set of so many tokens is cut, by the low bits of its tokens: a power of two."""
    return (1 << np.ceil(np.log2(np.maximum(tokens, PART) / PART)).astype(np.int64)).astype(np.int64)


def _shared_first(token: np.ndarray, own: pa.ChunkedArray, parts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many tokens of the part that the token of their group is in pairs of places (i, j) share; 0 unless it is the smallest of those.

    `own` has the sorted tokens of that part of the set at each place, `parts` the number of parts. Of two numbers of parts
    the larger one counts. So a pair counts once in each part, whatever the number of tokens it shares there.
    """
    places, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    mask, token = np.maximum(parts[i], parts[j]) - 1, token[i]
    i, j = at[:len(i)], at[len(i):]
    lists = [np.frombuffer(x, np.int64) for x in own.take(pa.array(places)).to_pylist()]
    lengths = np.array([len(x) for x in lists], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    names, number = np.unique(flat, return_inverse=True)
    keys = np.repeat(np.arange(len(lists)), lengths) * len(names) + number
    swap = lengths[i] > lengths[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    ends, found = np.cumsum(lengths[i]), np.zeros(len(i), np.int64)
    low = 0
    while low < len(i):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + HELD, "right")))
        one, other = i[low:high], j[low:high]
        pair = np.repeat(np.arange(len(one)), lengths[one])
        asked = np.arange(len(pair)) + np.repeat(starts[one] - np.concatenate([[0], np.cumsum(lengths[one])[:-1]]), lengths[one])
        there = np.flatnonzero((flat[asked] ^ token[low:high][pair]) & mask[low:high][pair] == 0)
        pair, asked = pair[there], asked[there]
        wanted = other[pair] * len(names) + number[asked]
        hit = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted)
        shared = np.bincount(pair[hit], minlength=len(one))
        met, first = np.unique(pair[hit], return_index=True)
        smallest = np.zeros(len(one), bool)
        smallest[met] = flat[asked[hit[first]]] == token[low:high][met]
        found[low:high] = np.where(smallest, shared, 0)
        low = high
    return found


def _met_first(token: np.ndarray, own: pa.ChunkedArray, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which pairs of places (i, j) of sets in one part share at least `least` tokens of which the smallest is that of the group they meet in."""
    return _shared_first(token, own, np.ones(len(token), np.int64), i, j) >= np.maximum(least, 1)


def _leaving(token: np.ndarray, own: pa.ChunkedArray, parts: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> list[np.ndarray]:
    """Places (i, j), shared tokens and how many of them the pair needs, for the pairs that leave the task of these tokens.

    Where both sets are in one part, pairs that share too few stay behind here.
    """
    least, n = least_shared(sizes[i], sizes[j], similarity), np.zeros(len(i), np.int64)
    whole = np.maximum(parts[i], parts[j]) == 1
    n[whole] = np.where(_met_first(token, own, i[whole], j[whole], least[whole]), least[whole], 0)
    n[~whole] = _shared_first(token, own, parts, i[~whole], j[~whole])
    stay = n > 0
    return [i[stay], j[stay], n[stay], least[stay]]


def _distinct(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Each pair once."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return [a[first], b[first]]


def only_tokens(sets: DataFrame, bits: Broadcast) -> DataFrame:
    """The sets that have a token in the filter, with those of their tokens alone."""
    arrow = to_arrow_schema(sets.schema)
    at = sets.columns.index("tokens")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            tokens, lengths = lists.flatten(), np.diff(lists.offsets.to_numpy())
            there = has(bits.value, tokens.to_numpy().view(np.uint64), RECURRING_POWER)
            left = np.bincount(np.repeat(np.arange(batch.num_rows), lengths)[there], minlength=batch.num_rows)
            ends = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
            columns = [*batch.columns[:at], pa.ListArray.from_arrays(ends, tokens.filter(pa.array(there))), *batch.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow).filter(pa.array(left > 0))

    return sets.mapInArrow(cut, sets.schema)


def met_tokens(labelled: DataFrame) -> DataFrame:
    """The tokens that stand in sets of different labels, stored: no other token has a pair to form."""
    told = labelled.select(F.explode("tokens").alias("token"), "label").groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return settled(told.where("low < high").select("token"), "met-tokens")


def filter_of(tokens: DataFrame) -> Broadcast:
    """A filter that lets all of these tokens through, and others by chance."""
    return tokens.sparkSession.sparkContext.broadcast(bits_of(tokens, "token", RECURRING_POWER))


def with_tokens(sets: DataFrame, each: DataFrame) -> DataFrame:
    """The sets that have rows (node, token), with those tokens in place of their own."""
    kept = each.groupBy(F.col("node").alias("kept")).agg(F.collect_list("token").alias("tokens"))
    return sets.drop("tokens").join(kept, F.col("node") == F.col("kept")).drop("kept").select(*sets.columns)


def only_met(sets: DataFrame, met: DataFrame, bits: Broadcast) -> DataFrame:
    """The sets that have a token of the table `met`, with those of their tokens alone.

    Its filter spares most others the move; the fuller it is, the more of them the join takes out.
    """
    each = only_tokens(sets, bits).select("node", F.explode("tokens").alias("token"))
    return with_tokens(sets, each.join(met, "token", "left_semi"))


def _dealt(sets: DataFrame, recurring: Broadcast, brings: bool) -> DataFrame:
    """A row for each set and each of its tokens in the filter, those of one token together and in the order of fingerprints.

    `own` has the tokens of the part that the token is in, where a set `brings` them along, and `parts` their number.
    """
    schema = "token long, place long, node long, label long, sketch binary, size int, marks binary, parts long, own binary"
    arrow = to_arrow_schema(sets.sparkSession.createDataFrame([], schema).schema)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            tokens = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            there = np.flatnonzero(has(recurring.value, tokens.view(np.uint64), RECURRING_POWER))
            counts = marks(owner[there], tokens[there].view(np.uint64), batch.num_rows)
            columns = {c: batch.column(c) for c in ("node", "label", "sketch", "size")}
            columns["marks"] = pa.array([row.tobytes() for row in counts], pa.binary())
            columns["place"] = pa.array((batch.column("fp").to_numpy().view(np.uint64) ^ SIGN).view(np.int64))
            lengths = np.bincount(owner[there], minlength=batch.num_rows)
            parts = part_count(lengths)
            columns["parts"] = pa.array(parts)
            # What sets bring along is some PART tokens for each of their tokens, so rows go out a bounded piece at a time.
            ends = np.concatenate([[0], np.cumsum(lengths)])
            weight = np.cumsum(lengths * np.minimum(lengths, PART)) if brings else ends[1:]
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(weight, (weight[low - 1] if low else 0) + HELD, "right")))
                kept, own = tokens[there[ends[low]:ends[high]]], owner[there[ends[low]:ends[high]]]
                if brings and len(kept):
                    part = kept & (parts[own] - 1)
                    order = np.lexsort((kept, part, own))
                    kept, own, part = kept[order], own[order], part[order]
                    cuts = np.flatnonzero((own[1:] != own[:-1]) | (part[1:] != part[:-1])) + 1
                    number = np.zeros(len(kept), np.int64)
                    number[cuts] = 1
                    brought = pa.array([x.tobytes() for x in np.split(kept, cuts)], pa.binary()).take(pa.array(np.cumsum(number)))
                else:
                    brought = pa.nulls(len(kept), pa.binary())
                whose = pa.array(own)
                yield pa.RecordBatch.from_arrays([pa.array(kept), *(columns[c].take(whose) for c in (
                    "place", "node", "label", "sketch", "size", "marks", "parts")), brought], schema=arrow)
                low = high

    placed = sets.select("node", "label", "fp", "sketch", "size", "tokens").mapInArrow(places, schema)
    return placed.repartition("token").sortWithinPartitions("token", "place", "node")


def _by_token(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]]:
    """Tables of `_dealt` with all rows of their tokens, their tokens, what `likely` counts, and the first places of tokens and the end."""

    def told(table: pa.Table) -> tuple:
        token = table.column("token").to_numpy()
        sketches, marked = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8).reshape(len(token), -1) for c in ("sketch", "marks"))
        counts = (table.column("size").to_numpy().astype(np.int64), sketches, marked)
        return table, token, counts, np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        # The last group of a batch may go on in the next one.
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        token = table.column("token").to_numpy()
        other = np.flatnonzero(token != token[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield told(table.slice(0, cut))
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield told(pa.Table.from_batches(held))


def open_tokens(sets: DataFrame, recurring: Broadcast, similarity: float) -> DataFrame:
    """(node, token) where a set meets one of another label that `likely` leaves open: all tokens that open pairs share are among them."""
    schema = "node long, token long"
    arrow = to_arrow_schema(sets.sparkSession.createDataFrame([], schema).schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, token, counts, cuts in _by_token(batches):
            open_ = np.zeros(len(token), bool)
            for i, j, _ in _open_pairs(table.column("label").to_numpy(), counts, cuts, similarity):
                open_[i] = open_[j] = True
            yield pa.RecordBatch.from_arrays([pa.array(table.column("node").to_numpy()[open_]), pa.array(token[open_])], schema=arrow)

    return _dealt(sets, recurring, False).mapInArrow(meet, schema)


def candidate_links(sets: DataFrame, recurring: Broadcast, similarity: float, way: str | bool) -> DataFrame:
    """Pairs (a, b) of distinct sets (columns node, label, fp, sketch, size, tokens) that may be alike.

    Fingerprints of sets at similarity 0.8 differ in so many bits that the keys of `simhash.links` would leave no bit to
    agree in, so sets are dealt out by token instead, of which alike sets share one. Pairs are left out that sizes or
    sketches or counts of their tokens rule out. Only tokens in the filter `recurring` are moved. By `way` these are returned:
    * `trie` (or False): the fingerprints that meet join a trie with itself at WIDE_BITS bits; a spanning forest of the pairs.
    * `best`: for each set that meets sets of other labels, the likeliest one under each of its tokens.
    * `all` (or True): all pairs that meet and have different labels, but for those that share fewer tokens than
      `least_shared`. The bounds are strict, so no alike pair is lost. A set brings tokens along: all, or of more than PART
      those of the part that the token is in. So a pair leaves the task of its smallest shared token alone, once in each part.
    The first two return at most one pair for each token of a set.
    """
    way = {False: "trie", True: "all"}.get(way, way)
    schema = "a long, b long" + ", n long, least long" * (way == "all")
    arrow = to_arrow_schema(sets.sparkSession.createDataFrame([], schema).schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []

        def sent(at_most: int) -> Iterator[pa.RecordBatch]:
            """A pair leaves once for all tokens of a task as far as LOT pairs allow."""
            if sum(len(part[0]) for part in found) > at_most:
                found[:] = [_distinct(*map(np.concatenate, zip(*found)))]
                if len(found[0][0]) > at_most // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.pop()], schema=arrow)

        for table, token, counts, cuts in _by_token(batches):
            nodes, label = (table.column(c).to_numpy() for c in ("node", "label"))
            if way == "all":
                for pairs in _other_pairs(label, counts, cuts, similarity):
                    i, j, n, least = _leaving(token, table.column("own"), table.column("parts").to_numpy(), counts[0], pairs[:, 0], pairs[:, 1], similarity)
                    columns = [np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j]), n, least]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=arrow)
                continue
            pairs = (_trie_links(token, nodes, counts, table.column("place").to_numpy().view(np.uint64) ^ SIGN, cuts, similarity) if way == "trie"
                     else _best_pairs(label, counts, cuts, similarity))
            i, j = pairs[:, 0], pairs[:, 1]
            found.append(_distinct(np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])))
            yield from sent(LOT)
        yield from sent(0)

    met = _dealt(sets, recurring, way == "all").mapInArrow(join, schema)
    if way == "all":
        return met.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("least").alias("least")).where("n >= least").select("a", "b")
    return met.distinct()


def groups(sets: list[np.ndarray], similarity: float) -> list[int]:
    """For each of some distinct sets a number, the same for sets that chains of alike sets connect.

    Sets whose fingerprints are neighbours are compared first, so most of a family of near copies is one group before the
    others are compared: those that share a token, are not yet in one group, and are not ruled out by sizes and sketches.
    Only pairs that pass and are not alike are remembered, so memory follows the sets.
    """
    label, members, tried = np.arange(len(sets)), {i: [i] for i in range(len(sets))}, set()
    sketches = np.frombuffer(b"".join(map(sketch, sets)), np.uint8).reshape(-1, CLASSES)
    sizes = np.array([len(own) for own in sets], np.int64)

    def meet(i: int, j: int) -> None:
        pair = min(i, j) * len(sets) + max(i, j)
        if label[i] == label[j] or pair in tried:
            return
        if alike(sets[i], sets[j], similarity):
            low, high = sorted((int(label[i]), int(label[j])), key=lambda x: len(members[x]))
            label[members[low]] = high
            members[high] += members.pop(low)
        else:
            tried.add(pair)

    fps = np.array([majority(own) for own in sets], np.int64).view(np.uint64)
    for turn in range(0, 64, 8):
        order = np.argsort(fps << np.uint64(turn) | fps >> np.uint64((64 - turn) % 64), kind="stable")
        for i, j in zip(order[:-1].tolist(), order[1:].tolist()):
            meet(i, j)
    first = [own[:len(own) - least_common(len(own), similarity) + 1] for own in sets]
    tokens, owner = np.concatenate(first), np.repeat(np.arange(len(sets), dtype=np.int32), [len(f) for f in first])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    cuts = np.concatenate([[0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1, [len(tokens)]])
    large = np.flatnonzero(np.diff(cuts) > 1)
    seen = set()  # shingles of one passage have the same owners
    for low, high in zip(cuts[:-1][large].tolist(), cuts[1:][large].tolist()):
        own = owner[low:high]
        if (name := xxhash.xxh3_128_intdigest(own.tobytes())) in seen:
            continue
        seen.add(name)
        if len(np.unique(label[own])) > 1:
            largest = Counter(label[own].tolist()).most_common(1)[0][0]
            for i in own[label[own] != largest].tolist():
                others = own[label[own] != label[i]]
                others = others[possible(sketches[others], sizes[others], sketches[i], int(sizes[i]), similarity)]
                for j in others.tolist():
                    meet(i, j)
    return label.tolist()


def _confirmed(pairs: DataFrame, source: DataFrame, rows: DataFrame, id_column: str, shingle: int, similarity: float) -> tuple[DataFrame, int]:
    """Those of the stored pairs (a, b) of nodes whose sets are alike, and the number of all: a task compares one pair after the other.

    The text of one row of each node is moved, and its set is stored once.
    """
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = rows.join(asked, "node").groupBy("node").agg(F.min(F.struct(F.col(id_column).alias("id"), "key")).alias("m")).select("node", "m.id", "m.key")
    met = (source.join(chosen, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key"))).select("node", "_text")
           .groupBy("node").agg(F.first("_text").alias("_text")))
    schema = "a long, b long"
    arrow = to_arrow_schema(pairs.schema)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = batch.column("one"), batch.column("other")
            stay = [alike(one[i].values.to_numpy().view(np.uint64), other[i].values.to_numpy().view(np.uint64), similarity) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(stay, pa.bool_())) for c in ("a", "b")], schema=arrow)

    with small_batches(pairs.sparkSession):
        sets = settled(map_texts(met, ["node"], "_text", lambda: lambda found: [[s.view(np.int64) for s in shingle_sets(found, shingle)]], "shingles array<long>"), "pair-sets")
        both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("one")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("other")), "b").select("a", "b", "one", "other"))
        links = settled(both.mapInArrow(check, schema), "alike-pairs")
    tried = pairs.count()
    discard(pairs, sets)
    return links, tried


def alike_roots(docs: DataFrame, rows: DataFrame, sets: DataFrame, id_column: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """(node, root) of every set that is alike to another: root is the smallest node of its group of alike sets.

    `rows` has the id, the `key` (digest of the text) and the node of each row; `sets`, a stored table that is removed here,
    has the other columns of `with_sets`, once for each node. Links of the trie are confirmed on the sets first, then those
    of each set to the likeliest set of another group. Both are few, and their groups spare the pairs inside; then all
    other pairs that may be alike are confirmed. No step needs a group in one place.
    """
    # Most tokens stand in one set alone; only those that recur are kept, with their sets.
    told = met_tokens(sets.withColumn("label", F.col("node")))
    first = filter_of(told)
    meeting = settled(only_met(sets, told, first), "meeting-sets")
    discard(sets, told)
    source = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("string").alias("_text"),
                         digest(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_key"))

    def confirmed(labelled: DataFrame, way: str) -> tuple[DataFrame, int]:
        if way == "trie":
            met = first
        else:
            told = met_tokens(labelled)
            met = filter_of(told)
            discard(told)
        steps = []
        with small_batches(docs.sparkSession):
            if way == "all":
                # Tokens that no open pair shares are not brought along: first all meet without.
                each = settled(open_tokens(labelled, met, similarity), "open-tokens")
                labelled = settled(with_tokens(labelled, each), "open-sets")
                steps = [each, labelled]
            pairs = settled(candidate_links(labelled, met, similarity, way), "similar-pairs")
        met.unpersist()
        discard(*steps)
        return _confirmed(pairs, source, rows, id_column, shingle, similarity)

    def labels(roots: DataFrame) -> DataFrame:
        linked = roots.select(F.col("node").alias("linked"), "root")
        return meeting.join(linked, meeting.node == linked.linked, "left").withColumn("label", F.coalesce("root", "node")).drop("linked", "root")

    links, tried = confirmed(meeting.withColumn("label", F.col("node")), "trie")
    roots, way = components(links), "best"
    while True:
        found, tried = confirmed(labels(roots), way)
        more = found.count()
        if more:
            links = links.unionByName(found)
            roots = components(links)
        # Where no set meets an open one of another group, no pair is left for `all` either.
        if way == "all" or not tried:
            break
        way = "best" if more >= AGAIN * tried else "all"
    discard(meeting)
    return roots
