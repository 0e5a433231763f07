"""Queries over the results of the stream: window statistics and status events."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.convert import round_to
from kerbflow.functions.status import EMPTY, FULL, NORMAL, OUT_OF_SERVICE
from kerbflow.functions.timefns import bucket, lit_like, seconds_between


def current_status(events: DataFrame) -> DataFrame:
    """Last event of each station. Events are combined before the shuffle, one row per station and task."""
    rest = [c for c in events.columns if c != "station_uid"]
    return events.groupBy("station_uid").agg(F.max_by(F.struct(*rest), "changed_at").alias("e")).select(
        "station_uid", "e.*")


def status_counts(events: DataFrame) -> DataFrame:
    """How many stations are empty, full or out of service now; a status without stations counts zero."""
    status = F.col("status")
    return current_status(events).agg(
        F.count_if(status == EMPTY).alias(EMPTY), F.count_if(status == FULL).alias(FULL),
        F.count_if(status == OUT_OF_SERVICE).alias(OUT_OF_SERVICE))


def recent_transitions(events: DataFrame, as_of: datetime, span: timedelta = timedelta(hours=1)) -> DataFrame:
    """Real transitions within the span; first sights do not count."""
    return events.where(F.col("previous_status").isNotNull()
                        & (F.col("changed_at") > lit_like(events, "changed_at", as_of - span))
                        ).agg(F.count(F.lit(1)).alias("value"))


def between(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    return df.where(F.col(column).between(lit_like(df, column, start), lit_like(df, column, end)))


def window_shares(stats: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Share of empty and full observations per window, weighted by observations."""
    n = F.sum("observations")
    return between(stats, "window_start", start, end).groupBy("window_start").agg(
        (F.sum("empty_observations") / n).alias("empty_share"), (F.sum("full_observations") / n).alias("full_share"))


def window_totals(stats: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Bikes of the whole city per window."""
    return between(stats, "window_start", start, end).groupBy("window_start").agg(
        F.sum("avg_bikes_available").alias("bikes"))


def transitions_over_time(events: DataFrame, start: datetime, end: datetime, seconds: int = 1800) -> DataFrame:
    """Transitions per bucket and kind, one row each."""
    status = F.col("status")
    label = (F.when(status == EMPTY, "became empty").when(status == FULL, "became full")
             .when(status == NORMAL, "back to normal").otherwise("out of service"))
    dtype = events.schema["changed_at"].dataType.simpleString()
    return between(events, "changed_at", start, end).where(F.col("previous_status").isNotNull()).groupBy(
        bucket(F.col("changed_at"), seconds, dtype).alias("time"), label.alias("metric")).agg(
        F.count(F.lit(1)).alias("value"))


def longest_ongoing(events: DataFrame, stations: DataFrame, as_of: datetime, n: int = 20) -> DataFrame:
    """Stations that have been empty or full for longest; a station without a name shows its id."""
    now = current_status(events).where(F.col("status").isin(EMPTY, FULL)).orderBy("changed_at", "station_uid").limit(n)
    return now.join(stations.select("station_uid", "station_name"), "station_uid", "left").select(
        F.coalesce("station_name", "station_uid").alias("station"), "status", "changed_at",
        seconds_between(F.col("changed_at"), lit_like(events, "changed_at", as_of)).alias("seconds"))


def most_often_empty(stats: DataFrame, stations: DataFrame, start: datetime, end: datetime, n: int = 20) -> DataFrame:
    """Stations with the highest share of empty observations, then the most observations."""
    per_station = between(stats, "window_start", start, end).groupBy("station_uid").agg(
        (F.sum("empty_observations") / F.sum("observations")).alias("empty_share"),
        round_to(F.avg("avg_bikes_available"), 1).alias("avg_bikes"), F.sum("observations").alias("observations"))
    top = per_station.orderBy(F.desc("empty_share"), F.desc("observations"), "station_uid").limit(n)
    return top.join(stations.select("station_uid", "station_name"), "station_uid", "left").select(
        F.coalesce("station_name", "station_uid").alias("station"), "empty_share", "avg_bikes", "observations")
