"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.labelled import remainder, sample
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import map_texts

#: Abusive words and how strong they are before any label is seen (1 mild, 3 strong).
LEXICON = {
    "arsehole": 3, "asshole": 3, "bastard": 3, "bitch": 3, "bullshit": 2, "clown": 1, "coward": 1, "cretin": 3, "cunt": 3,
    "degenerate": 2, "dickhead": 3, "dimwit": 2, "disgusting": 2, "dumb": 2, "dumbass": 3, "dunce": 2, "fool": 1, "freak": 2,
    "fuck": 3, "fucking": 3, "garbage": 1, "hideous": 1, "idiot": 3, "idiotic": 2, "idiots": 3, "imbecile": 3, "jerk": 2,
    "kys": 3, "liar": 1, "loser": 2, "losers": 2, "lowlife": 2, "moron": 3, "moronic": 2, "morons": 3, "motherfucker": 3,
    "pathetic": 2, "pig": 1, "prick": 2, "repulsive": 2, "scum": 3, "scumbag": 3, "shit": 2, "shithead": 3, "slut": 3, "stupid": 2,
    "trash": 1, "twat": 3, "ugly": 1, "vermin": 2, "wanker": 3, "whore": 3, "worthless": 2,
    "abruti": 3, "connard": 3, "connasse": 3, "salope": 3, "arschloch": 3, "dummkopf": 2, "wichser": 3, "vollidiot": 3,
    "estupido": 2, "gilipollas": 3, "imbecil": 3, "pendejo": 3,
}

#: Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = ["class clown", "clown fish", "circus clown", "trash bag", "trash bin", "trash can", "trash collection", "garbage bag",
              "garbage bin", "garbage can", "garbage collection", "garbage collector", "guinea pig", "pig farm", "fool proof",
              "stupid simple", "ugly duckling", "jerk chicken", "jerk seasoning"]

#: Look-alikes of Latin letters outside the compatibility decompositions, and digits and signs put for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ү": "y", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ɡ": "g", "ɑ": "a", "ß": "b", "ℓ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "£": "l"}

#: At most this many labelled rows are used to fit the weights.
SAMPLE_ROWS = 10_000
THRESHOLD = 0.5
#: Bounds on what is learned beside the given words.
MAX_LEARNED, LEAST_RATIO = 1000, 12.0
#: Prior mean and precision of the intercept and the slope on the logarithm of the density.
PRIOR = (np.array([-3.0, 2.5]), np.array([0.3, 0.3]))


class Folding(dict):
    """A translation table filled as characters are met: lower case, no marks, look-alikes and digits as letters."""

    def __missing__(self, code: int) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)).lower() if not unicodedata.combining(c))
        out = "".join(DIGITS.get(c) or LOOKALIKES.get(c, c) for c in plain)
        if unicodedata.category(chr(code)) == "Cf":  # zero-width characters inside words
            out = ""
        self[code] = out
        return out


class Matcher:
    """Counts of lexicon entries in a text, less those inside an exception phrase.

    An entry is a whole word, or with a final `*` the beginning of a word. Of entries that begin at one place the longest
    counts.
    """

    def __init__(self, lexicon: list[str], exceptions: list[str]) -> None:
        self.folding = Folding()
        self.automaton = ahocorasick.Automaton()
        self.size = len(lexicon)
        for i, entry in enumerate(lexicon):
            word = entry.rstrip("*")
            self.automaton.add_word(word, (i, len(word), not entry.endswith("*")))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (-1, len(phrase), True))
        if lexicon or exceptions:
            self.automaton.make_automaton()

    def count(self, text: bytes) -> tuple[int, dict[int, int]]:
        folded = text.decode("utf-8", "replace").translate(self.folding)
        hits: dict[int, tuple[int, int]] = {}  # start -> last character and entry
        spared = []
        for end, (word, size, whole) in self.automaton.iter(folded) if self.size else ():
            start = end - size + 1
            if (start and folded[start - 1].isalnum()) or (whole and folded[end + 1:end + 2].isalnum()):
                continue
            if word < 0:
                spared.append((start, end))
            elif start not in hits or hits[start][0] < end:
                hits[start] = end, word
        found: dict[int, int] = {}
        spared.sort()
        at, reach = 0, -1  # the furthest end of the exceptions that start no later than the hit
        for start, (end, word) in sorted(hits.items()):
            while at < len(spared) and spared[at][0] <= start:
                reach = max(reach, spared[at][1])
                at += 1
            if end > reach:
                found[word] = found.get(word, 0) + 1
        return len(folded.split()), found


@dataclass(frozen=True)
class ToxicityModel:
    words: list[str]
    weights: list[float]
    intercept: float
    slope: float

    def density(self, n_words: int, found: dict[int, int]) -> float:
        return sum(self.weights[w] * c for w, c in found.items()) * 100.0 / (n_words + 50.0)

    def score(self, n_words: int, found: dict[int, int]) -> float:
        z = self.intercept + self.slope * np.log1p(self.density(n_words, found))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def stems(text: bytes, folding: Folding) -> list[str]:
    """Distinct beginnings, of four to ten letters, of the folded words of a text."""
    found = set()
    for word in set(re.findall(r"[^\W_]+", text.decode("utf-8", "replace").translate(folding))):
        found.update(word[:k] for k in range(4, min(len(word), 10) + 1))
    return sorted(found)


def learned_entries(labelled: DataFrame, lexicon: dict[str, int]) -> list[tuple[str, float]]:
    """Word beginnings, with log-odds, that mark toxic texts of the sample, at most MAX_LEARNED of them.

    One must stand in at least 1.5 % of the toxic texts (five at least) and be LEAST_RATIO times as frequent there as in
    the others. The counting is a Spark aggregation; only the entries that pass reach the driver.
    """
    def make():
        folding = Folding()
        return lambda texts: [[stems(t, folding) for t in texts]]

    totals = labelled.agg(F.count_if(F.col("_label") == 1), F.count("*")).first()
    toxic, other = totals[0], totals[1] - totals[0]
    counted = (map_texts(labelled, ["_label"], "_text", make, "stem array<string>").select("_label", F.explode("stem").alias("stem"))
               .groupBy("stem").agg(F.count_if(F.col("_label") == 1).alias("a"), F.count_if(F.col("_label") != 1).alias("b")))
    ratio = (F.col("a") + 0.5) / (toxic + 1.0) / ((F.col("b") + 0.5) / (other + 1.0))
    rows = (counted.where((F.col("a") >= max(5, 0.015 * toxic)) & (ratio >= LEAST_RATIO))
            .select("stem", F.log(ratio).alias("w")).orderBy(F.desc("w"), "stem").limit(MAX_LEARNED).collect())
    known = tuple(lexicon)
    return [(f"{r.stem}*", float(r.w)) for r in rows if not r.stem.startswith(known)]


def fit_toxicity(labelled: DataFrame, lexicon: dict[str, int] | None = None, exceptions: list[str] | None = None) -> ToxicityModel:
    """Weights of the lexicon, further entries, and two calibration numbers from (_label, _text) rows.

    Of each labelled text only its length and the lexicon entries in it reach the driver; `sample` bounds the rows.
    Without labels the prior strengths alone decide. Weights are log-odds of a word in toxic against other texts, with
    pseudo-counts by the word's strength, and never below zero.
    """
    lexicon = LEXICON if lexicon is None else lexicon
    exceptions = EXCEPTIONS if exceptions is None else exceptions
    learned = learned_entries(labelled, lexicon)
    words = sorted(lexicon) + [entry for entry, _ in learned]

    def make():
        matcher = Matcher(words, exceptions)

        def derive(texts):
            found = [matcher.count(t) for t in texts]
            return [[n for n, _ in found], [sorted(f) for _, f in found], [[f[w] for w in sorted(f)] for _, f in found]]
        return derive

    rows = map_texts(labelled, ["_label"], "_text", make, "n long, words array<int>, counts array<int>").toArrow().to_pylist()
    toxic = sum(r["_label"] == 1 for r in rows)
    seen = {1: np.zeros(len(words)), 0: np.zeros(len(words))}
    for r in rows:
        seen[int(r["_label"] == 1)][r["words"]] += 1
    weights = []
    for i, word in enumerate(sorted(lexicon)):
        in_toxic = (seen[1][i] + 0.2 * lexicon[word]) / (toxic + 4.0)
        in_other = (seen[0][i] + 0.02) / (len(rows) - toxic + 4.0)
        weights.append(float(np.clip(np.log(in_toxic / in_other), 0.0, 6.0)))
    weights += [min(w, 6.0) for _, w in learned]
    model = ToxicityModel(words, weights, *PRIOR[0])
    x = np.array([np.log1p(model.density(r["n"], dict(zip(r["words"], r["counts"])))) for r in rows])
    y = np.array([float(r["_label"] == 1) for r in rows])
    beta, design = PRIOR[0].copy(), np.column_stack([np.ones(len(x)), x])
    for _ in range(30):  # Newton steps to the most probable pair
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - PRIOR[1] * (beta - PRIOR[0])
        curvature = (design * (p * (1 - p))[:, None]).T @ design + np.diag(PRIOR[1])
        beta = beta + np.clip(np.linalg.solve(curvature, gradient), -2, 2)
    return ToxicityModel(words, weights, float(beta[0]), float(beta[1]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text",
                   exceptions: list[str] | None = None) -> DataFrame:
    """The `keep` columns, score (0 to 1), the number of words, and the lexicon words found.

    A null or empty text has no hits and gets the score of such texts. Rows are judged one by one: ids may be null or
    repeated, and other columns are not read.
    """
    exceptions = EXCEPTIONS if exceptions is None else exceptions

    def make():
        matcher = Matcher(model.words, exceptions)

        def derive(texts):
            found = [matcher.count(t) for t in texts]
            return [[model.score(n, f) for n, f in found], [n for n, _ in found],
                    [[model.words[w] for w in sorted(f)] for _, f in found]]
        return derive

    return map_texts(docs, keep, text, make, "score double, n_words long, toxic_words array<string>")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    labelled = sample(docs, labels, "doc_id", "text", "toxic", remainder("doc_id", 5) != 0, SAMPLE_ROWS)
    scored = score_toxicity(docs, fit_toxicity(labelled), ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
