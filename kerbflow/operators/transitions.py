"""Status changes of stations: full history in one pass, and batch by batch with keyed state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.status import NORMAL, classify
from kerbflow.functions.timefns import micros, seconds_between
from kerbflow.operators.dedupe import first_per_key
from kerbflow.operators.merge import upsert
from kerbflow.operators.sequence import ROWS_PER_SLICE, Cut, cut_hot_keys, neighbour

KEY, TS = "station_uid", "source_updated_at"
EVENT_COLUMNS = ["station_uid", "status", "previous_status", "changed_at", "previous_duration_seconds",
                 "bikes_available", "docks_available"]


def _with_status(cut: Cut) -> Cut:
    return cut.of(cut.rows.withColumn(
        "status", classify(F.col("bikes_available"), F.col("docks_available"), F.col("service_status"))))


def _one_per_instant(observations: DataFrame, arrival: list[str]) -> DataFrame:
    """The first copy of each instant to arrive. The key holds the instant, so a hot station is spread by time."""
    return first_per_key(observations, [KEY, TS], arrival) if arrival else observations


def _changes(observations: DataFrame, arrival: list[str], rows_per_slice: int) -> Cut:
    """Rows at which the status differs from the one before (the first sight of a station included)."""
    cut = cut_hot_keys(_one_per_instant(observations, arrival), [KEY], [TS], rows_per_slice)
    seen = neighbour(_with_status(cut), [TS], {"status": "__before"})
    return seen.of(seen.rows.where(~F.col("status").eqNullSafe(F.col("__before"))).drop("__before"))


def _as_events(changes: DataFrame) -> DataFrame:
    """A first sight counts only when the station is not normal."""
    return changes.where(F.col("previous_status").isNotNull() | (F.col("status") != NORMAL)).select(
        "station_uid", "status", "previous_status", F.col(TS).alias("changed_at"),
        seconds_between(F.col("__since"), F.col(TS)).alias("previous_duration_seconds"),
        "bikes_available", "docks_available",
    )


def status_events_batch(observations: DataFrame, arrival: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """All status changes of a whole history. Copies of one instant count once, the first to arrive."""
    changes = _changes(observations, arrival, rows_per_slice)
    return _as_events(neighbour(changes, [TS], {"status": "previous_status", TS: "__since"}).rows)


def advance_status(state: DataFrame, batch: DataFrame, arrival: list[str],
                   rows_per_slice: int = ROWS_PER_SLICE) -> tuple[DataFrame, DataFrame]:
    """One step of the keyed detector: (events of this batch, new state).

    State rows (status, since_us, last_seen_us) enter as the change before the batch, so one pass orders old and
    new together. Rows not newer than `last_seen_us` are ignored; stations absent from the batch keep their state.
    Store the new state before the next step, so that plans do not grow from batch to batch.
    """
    old = state.select(
        KEY, F.col("status").alias("__old_status"), F.col("since_us").alias("__old_since"),
        F.col("last_seen_us").alias("__old_seen"))
    fresh = (
        batch.join(old, KEY, "left")
        .where(F.col("__old_seen").isNull() | (micros(F.col(TS)) > F.col("__old_seen")))
    )
    cut = cut_hot_keys(_one_per_instant(fresh, arrival), [KEY], [TS], rows_per_slice)
    seen = neighbour(_with_status(cut), [TS], {"status": "__before"})
    before = F.coalesce("__before", "__old_status")
    changes = seen.rows.where(~F.col("status").eqNullSafe(before)).drop("__before")
    linked = neighbour(seen.of(changes), [TS], {"status": "__ps", TS: "__pt"}).rows
    linked = linked.withColumn("previous_status", F.coalesce("__ps", "__old_status")).withColumn(
        "__since", F.coalesce(F.col("__pt").cast("timestamp"), F.timestamp_micros("__old_since")))
    events = _as_events(linked)

    last_change = changes.groupBy(KEY).agg(F.max_by("status", TS).alias("__status"), F.max(TS).alias("__changed"))
    touched = fresh.groupBy(KEY).agg(
        F.max(micros(F.col(TS))).alias("last_seen_us"), F.first("__old_status").alias("__old_status"),
        F.first("__old_since").alias("__old_since"))
    new_rows = touched.join(last_change, KEY, "left").select(
        KEY,
        F.coalesce("__status", "__old_status").alias("status"),
        F.coalesce(micros(F.col("__changed")), F.col("__old_since")).alias("since_us"),
        "last_seen_us",
    )
    return events, upsert(state.select(KEY, "status", "since_us", "last_seen_us"), new_rows, [KEY])
