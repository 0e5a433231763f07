"""Substring dedup by words: recurring passages are compiled into Aho-Corasick automata that find every occurrence."""

from __future__ import annotations

import hashlib
from collections import Counter

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from kerbflow.llm.recurring import Units, merged, with_recurring
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import map_texts, under_plain_names

WINDOW, GRAM = 35, 8
UNITS = Units(WINDOW, GRAM, words=True)


def word_windows(body: bytes) -> list[bytes]:
    words = body.split()
    return [b" ".join(words[i:i + WINDOW]) for i in range(len(words) - WINDOW + 1)]


def find_passages(stretches: list[tuple[bytes, int]]) -> list[list[tuple[int, int]]]:
    """Word ranges of each stretch that recurring windows cover.

    Words become characters of a private alphabet of this shard, so that an automaton over them steps word by word. The
    windows that stand in two places are confirmed first; only those are compiled, and all stretches are streamed.
    """
    alphabet: dict[bytes, str] = {}

    def letter(word: bytes) -> str:
        known = alphabet.get(word)
        if known is None:
            number = len(alphabet) + 1
            known = alphabet[word] = chr(number if number < 0xD800 else number + 0x800)
        return known

    lines = ["".join(map(letter, body.split())) for body, _ in stretches]
    places: Counter[str] = Counter()
    for line, (_, count) in zip(lines, stretches):
        for i in range(len(line) - WINDOW + 1):
            places[line[i:i + WINDOW]] += count
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for passage, count in places.items():
        if count > 1:
            automaton.add_word(passage)
    if not len(automaton):
        return [[] for _ in stretches]
    automaton.make_automaton()
    covered = []
    for line in lines:
        runs: list[tuple[int, int]] = []
        for end, _ in automaton.iter(line):
            start = end - WINDOW + 1
            if runs and start <= runs[-1][1]:
                runs[-1] = runs[-1][0], end + 1
            else:
                runs.append((start, end + 1))
        covered.append(runs)
    return covered


def repeated_words(n: int, runs: list[dict] | None, whole: bool) -> list[tuple[int, int]]:
    return [(0, n)] if whole and n >= WINDOW else merged(runs)


def kept_words(text: bytes, runs: list[dict] | None, whole: bool) -> tuple[int, list[bytes]]:
    """Number of words, and the words that no recurring window covers."""
    words = text.split()
    kept, at = [], 0
    for low, high in repeated_words(len(words), runs, whole):
        kept += words[at:low]
        at = high
    return len(words), kept + words[at:]


def remove_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs`, the text without its recurring passages, and n_words, n_removed, kept_sha256 (also in place of
    such columns of `docs`).

    A word goes if any window of 35 words around it also starts anywhere else, in this text or another; all places go,
    the first too. Windows are judged on the input. Kept words are joined by one space where something was removed, and
    a text from which nothing goes stays as it is (null stays null). Texts of fewer than 35 words lose nothing, copies
    of a longer text lose all. Ids may be null or repeated; each row counts as a text of its own.
    """
    docs, back = under_plain_names(docs.drop("n_words", "n_removed", "kept_sha256"), [id_column, text])
    found = with_recurring(docs, id_column, text, UNITS, find_passages, word_windows)

    def make():
        def derive(texts, runs, whole, old):
            out = []
            for t, r, w, o in zip(texts, runs, whole, old):
                n, kept = kept_words(t, r, w)
                line = b" ".join(kept)
                out.append((o if len(kept) == n else line.decode("utf-8", "replace"), n, n - len(kept), hashlib.sha256(line).hexdigest()))
            return [list(c) for c in zip(*out)] if out else [[], [], [], []]
        return derive

    cut = map_texts(found, docs.columns, text, make, f"`{text}` string, n_words long, n_removed long, kept_sha256 string",
                    use=("_runs", "_whole", text))
    # The text comes last among the fields; the caller's order is restored.
    return back(cut.select(*docs.columns, "n_words", "n_removed", "kept_sha256"))


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
