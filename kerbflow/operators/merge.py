"""Merges as relational expressions: what a keyed table holds after a batch.

The target side is never re-ranked. It is only filtered by the keys of the batch, so with the usual small batch
the join is a broadcast one chosen by Spark from measured sizes, and the target is streamed once.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.timefns import lit_like
from kerbflow.operators.dedupe import first_per_key, latest_per_key


def _one_per_key(batch: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    return latest_per_key(batch, keys, order) if order else batch


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None,
           stamp: tuple[str, Column] | None = None, evolve: bool = False) -> DataFrame:
    """Rows of the batch replace target rows of the same key; the rest is inserted.

    `order` picks the row to keep where the batch repeats a key, `stamp` sets an update-time column, and `evolve`
    lets the batch bring new columns.
    """
    rows = _one_per_key(batch, keys, order)
    if stamp:
        rows = rows.withColumn(*stamp)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=evolve)


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None,
             target_filter: Column | None = None) -> DataFrame:
    """Rows of the batch whose key the target lacks. `target_filter` bounds the part of the target that is read."""
    scanned = target if target_filter is None else target.where(target_filter)
    absent = batch.join(scanned.select(*keys), keys, "left_anti")
    return first_per_key(absent, keys, order) if order else absent


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None,
               target_filter: Column | None = None, evolve: bool = False) -> DataFrame:
    """Target plus the rows of the batch whose key it lacks."""
    return target.unionByName(new_rows(target, batch, keys, order, target_filter), allowMissingColumns=evolve)


def incremental_slice(source: DataFrame, target: DataFrame, loaded_at: str, event_at: str, lookback: timedelta,
                      bound: timedelta, as_of: datetime) -> DataFrame:
    """Source rows loaded since the newest load in the target minus the look-back, inside the merge window.

    An empty target gives the whole source: there is nothing to look back from. The newest load is one value, read
    first, so that both bounds are literals that prune directories and row groups of the source.
    """
    newest = target.agg(F.max(loaded_at)).first()[0]
    if newest is None:
        return source
    return source.where((F.col(loaded_at) >= lit_like(source, loaded_at, newest - lookback))
                        & (F.col(event_at) >= lit_like(source, event_at, as_of - bound)))


def merge_incremental(target: DataFrame, batch: DataFrame, keys: list[str], event_at: str, since: datetime,
                      when_matched: Literal["keep", "update"] = "keep", evolve: bool = False) -> DataFrame:
    """New content of the recent part of the target (rows with `event_at >= since`) after merging the batch.

    `keep` leaves a matched row as it was first stored, so that increments add up to the full build; `update`
    overwrites it. Older partitions are neither read nor returned: the caller replaces the touched ones only.
    """
    recent = target.where(F.col(event_at) >= lit_like(target, event_at, since))
    if when_matched == "keep":
        return insert_new(recent, batch, keys, evolve=evolve)
    return upsert(recent, batch, keys, evolve=evolve)


def select_changed(batch: DataFrame, seen: DataFrame, key: str, ts: str) -> DataFrame:
    """Change feed: rows strictly newer than the last one sent for their key. Rows without time are skipped."""
    marks = seen.select(key, F.col(ts).alias("__seen"))
    joined = batch.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).join(marks, key, "left")
    return joined.where(F.col("__seen").isNull() | (F.col(ts) > F.col("__seen"))).drop("__seen")


def commit_seen(seen: DataFrame, delivered: DataFrame, key: str, ts: str) -> DataFrame:
    """High-water marks after a delivery. Call it with delivered rows only; other keys keep their mark."""
    both = seen.select(key, ts).unionByName(delivered.select(key, ts))
    return both.groupBy(key).agg(F.max(ts).alias(ts))
