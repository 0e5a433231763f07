"""One row per key.

Both operators rank rows and keep rank 1. Spark applies that limit before the shuffle as well as after it
(`WindowGroupLimit` in the plan), so a key that holds a third of all rows sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int | None = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each key in the given order, or all for None; `rank` keeps the position as a column."""
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked if n is None else ranked.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Earliest row of each key."""
    return top_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], recent: Column | None = None) -> DataFrame:
    """Latest row of each key, looking only at rows that pass `recent`."""
    source = df if recent is None else df.where(recent)
    return top_per_key(source, keys, [F.col(c).desc_nulls_last() for c in order])
