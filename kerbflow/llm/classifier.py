"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.blocks import Block, block, grams, mix, word_hashes
from kerbflow.llm.labelled import remainder, sample
from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import map_texts, pieces
from pyspark.sql.pandas.types import to_arrow_schema

BITS = 18
#: At most this many labelled rows are used to fit the weights.
SAMPLE_ROWS = 12_000
#: Learners that each see a part of the sample and whose states are averaged, and how often.
LEARNERS, ROUNDS = 4, 4
#: Follow-the-regularised-leader: step size, its damping, and the two penalties.
ALPHA, BETA, L1, L2 = 0.3, 0.3, 0.02, 0.02
THRESHOLD = 0.7

#: What a byte says about the look of its word.
_LOOK = np.zeros(256, np.uint8)
for _c in range(256):
    _LOOK[_c] = (1 if 65 <= _c <= 90 else 2 if 97 <= _c <= 122 else 4 if 48 <= _c <= 57 else 8 if _c >= 128
                 else 0 if _c == 32 or 9 <= _c <= 13 else 16 if chr(_c) in ".,;:'\"()?-" else 32)


def looks(b: Block) -> np.ndarray:
    """A small code for the look of each word: kinds of its characters, its length, whether it repeats one just before."""
    if not len(b.starts):
        return np.zeros(0, np.uint64)
    kinds = np.bitwise_or.reduceat(_LOOK[b.data], b.starts).astype(np.uint64)
    size = np.minimum(b.ends - b.starts, 15).astype(np.uint64) // np.uint64(3)
    h = word_hashes(b)
    row, again = b.row_of_word(), np.zeros(len(h), np.uint64)
    for back, bit in ((2, 2), (1, 1)):
        same = (h[back:] == h[:-back]) & (row[back:] == row[:-back])
        again[back:][same] |= np.uint64(bit)
    return kinds | size << np.uint64(6) | again << np.uint64(9)


def features(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed index of each n-gram: words in ones and twos, looks of words in ones, twos and threes."""
    row = b.row_of_word()
    words, look = word_hashes(b), looks(b)
    rows, index = [], []
    for kind, (values, k) in enumerate(((words, 1), (words, 2), (look, 1), (look, 2), (look, 3))):
        n = max(0, len(values) - k + 1)
        inside = row[:n] == row[k - 1:k - 1 + n]
        h = mix(grams(values, k) + np.uint64(0x632BE59BD9B4E019 * (kind + 1) & (1 << 64) - 1))
        rows.append(row[:n][inside])
        index.append((h >> np.uint64(64 - BITS))[inside].astype(np.int64))
    return np.concatenate(rows), np.concatenate(index)


@dataclass
class Ftrl:
    """State of the per-coordinate updates; weights follow from it."""

    z: np.ndarray
    n: np.ndarray
    bias_z: float = 0.0
    bias_n: float = 0.0

    @classmethod
    def empty(cls) -> Ftrl:
        return cls(np.zeros(1 << BITS), np.zeros(1 << BITS))

    @staticmethod
    def _weights(z, n, l1=L1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def weights(self) -> tuple[np.ndarray, float]:
        return self._weights(self.z, self.n), float(self._weights(self.bias_z, self.bias_n, 0.0))

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self._weights(self.z[index], self.n[index])
        bias = float(self._weights(self.bias_z, self.bias_n, 0.0))
        g = 1 / (1 + np.exp(-np.clip(w @ value + bias, -30, 30))) - label
        grad = g * value
        sigma = (np.sqrt(self.n[index] + grad * grad) - np.sqrt(self.n[index])) / ALPHA
        self.z[index] += grad - sigma * w
        self.n[index] += grad * grad
        sigma = (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / ALPHA
        self.bias_z += g - sigma * bias
        self.bias_n += g * g


def scale(counts: np.ndarray) -> np.ndarray:
    """Weight of one n-gram in a text with so many words: long texts count little more than short ones."""
    return 3.0 / np.sqrt(np.maximum(counts, 1) * 20.0 + 400.0)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float

    @property
    def taught(self) -> bool:
        """Has any label moved the model? If not, every score is 0.5."""
        return bool(self.bias) or bool(self.weights.any())

    def score(self, b: Block) -> np.ndarray:
        rows, index = features(b)
        total = np.bincount(rows, self.weights[index], b.rows) * scale(b.counts()) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_quality(labelled: DataFrame) -> QualityModel:
    """A model from (_order, _label, _text) rows: each learner runs through its part, then the states are averaged.

    Texts stay on the executors. What comes back per round is one row per learner and touched coordinate, averaged by
    Spark, so at most 2**18 rows whatever the input. Without labels the model gives 0.5.
    """
    spark = labelled.sparkSession
    parts = labelled.repartition(LEARNERS).sortWithinPartitions("_order").persist()
    state = Ftrl.empty()
    schema = "i int, z double, n double"
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    try:
        for _ in range(ROUNDS):
            shared = spark.sparkContext.broadcast(state)

            def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                start = shared.value
                own, seen = Ftrl(start.z.copy(), start.n.copy(), start.bias_z, start.bias_n), False
                for piece in pieces(batches, "_text"):
                    b = block(piece.column("_text"))
                    rows, index = features(b)
                    at = np.argsort(rows, kind="stable")
                    cuts = np.searchsorted(rows[at], np.arange(b.rows + 1))
                    factor, index = scale(b.counts()), index[at]
                    for i, label in enumerate(piece.column("_label").to_pylist()):
                        unique, counts = np.unique(index[cuts[i]:cuts[i + 1]], return_counts=True)
                        own.update(unique, counts * factor[i], label)
                        seen = True
                if seen:
                    touched = np.flatnonzero(own.n)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.append(touched, -1).astype(np.int32)), pa.array(np.append(own.z[touched], own.bias_z)),
                        pa.array(np.append(own.n[touched], own.bias_n))], schema=arrow)

            # A learner that has not touched a coordinate still holds the shared start there.
            rows = (parts.mapInArrow(learn, schema).groupBy("i")
                    .agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count("*").alias("c")).toArrow())
            i, z, n, c = (rows.column(k).to_numpy() for k in "iznc")
            learners = int(c[i == -1][0]) if len(i) else 1
            at, bias = i[i >= 0], i == -1
            merged = Ftrl(state.z.copy(), state.n.copy(), state.bias_z, state.bias_n)
            merged.z[at] = (z[i >= 0] + (learners - c[i >= 0]) * state.z[at]) / learners
            merged.n[at] = (n[i >= 0] + (learners - c[i >= 0]) * state.n[at]) / learners
            if len(i):
                merged.bias_z, merged.bias_n = float(z[bias][0] / learners), float(n[bias][0] / learners)
            state = merged
    finally:
        parts.unpersist()
    return QualityModel(*state.weights())


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The `keep` columns and the probability (0 to 1) that a text is of quality.

    A sparse dot product per row: n-grams are hashed and their weights looked up and summed. A null or empty text has no
    n-grams, so the bias alone decides. Rows are judged one by one; ids may be null or repeated.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2**18 weights whatever the input: 2 MB

    def make():
        def derive(texts):
            return [shared.value.score(block(pa.array(texts, pa.large_binary())))]
        return derive

    return map_texts(docs, keep, text, make, f"{name} double")


def trained(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """The production model: fitted on ids of the remainders 0, 1 and 3, never on those held out."""
    return fit_quality(sample(docs, labels, "doc_id", "text", "quality", remainder("doc_id", 4) != 2, SAMPLE_ROWS))


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(docs, trained(docs, labels), ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
