"""A bounded sample of labelled rows to fit small models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_column: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo `folds`; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, usable: Column, at_most: int) -> DataFrame:
    """(_order, _label, _text) of at most `at_most` labelled rows: those whose ids have the smallest hashes.

    Every labelled id has the same chance, whatever its place in the tables; below the bound all rows are taken. An id
    with several labels counts with the smallest one, and an id that stands on several rows gives the row with the
    smallest text. Only the ids are ordered; texts are read for the chosen ids alone.
    """
    known = (labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull()).where(usable)
             .groupBy(F.col(id_column).alias("_id")).agg(F.min(label).alias("_label")))
    # At most `at_most` ids: the bound that makes this broadcast safe.
    chosen = known.withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(at_most)
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return (rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_order", "_label").agg(F.min("_text").alias("_text"))
            .select("_order", F.col("_label").cast("int").alias("_label"), "_text"))
