"""From raw documents to packed sequences: five stages, each on all that the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.classifier import THRESHOLD, score_quality, trained
from kerbflow.llm.decontaminate import contamination
from kerbflow.llm.packing import pack_texts, word_bpe
from kerbflow.llm.phrases import remove_repeated_passages
from kerbflow.llm.recurring import digest
from kerbflow.llm.registry import table
from kerbflow.llm.rows import under_plain_names
from kerbflow.llm.simhash import one_of_each
from kerbflow.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier accepts; it learns from the labels of this data set, held-out ids aside.

    A null or empty text is scored by the bias alone. Other columns pass through, whatever their names. Where no label
    can be used (no labels, none of these documents, or all ids held out), nothing is known of quality and all rows pass.
    """
    model = trained(docs, table(spark, sf_dir, "labels"))
    if not model.taught:
        return docs
    rows, back = under_plain_names(docs, ["doc_id", "text"])
    return back(score_quality(rows, model, rows.columns, name="score").where(F.col("score") >= THRESHOLD).select(*rows.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id (a null before all others).

    Near copies have sets of 5-word shingles with a Jaccard similarity of 0.8 or more, confirmed on the sets; chains count.
    """
    return one_of_each(docs, shingle=5, similarity=0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the words of passages that stand in two places; n_chars follows the text that is left."""
    rows, back = under_plain_names(docs, ["doc_id", "text", "n_chars"])
    cut = remove_repeated_passages(rows).select(*rows.columns)
    if "n_chars" in rows.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return back(cut)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no window with an item of the benchmark."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    tainted = found.where("n_hit > 0").select(F.col("key").alias("_key")).distinct()
    rows, back = under_plain_names(docs, ["doc_id", "text"])
    keyed = rows.withColumn("_key", digest(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return back(keyed.join(tainted, "_key", "left_anti").select(*rows.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts in sequences of at most 2048 tokens."""
    return pack_texts(docs, "doc_id", word_bpe)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminate),
    ("packing", packing),
]

#: The classifier and the tokenizer have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
