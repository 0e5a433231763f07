"""Time expressions. Instants are UTC; the zone of local values is always a parameter."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lit_like(df: DataFrame, name: str, value: datetime) -> Column:
    """A UTC datetime as a literal of the column's own type, so that the filter reaches the scan."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(df.schema[name].dataType)


def since(df: DataFrame, name: str, as_of: datetime, age: timedelta) -> Column:
    return F.col(name) >= lit_like(df, name, as_of - age)


def micros(col: Column) -> Column:
    """Epoch microseconds."""
    return F.unix_micros(col.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.floor((micros(end) - micros(start)) / F.lit(1_000_000)).cast("long")


def bucket(col: Column, seconds: int, dtype: str = "timestamp") -> Column:
    """Start of the epoch-aligned bucket that holds an instant."""
    start = F.floor(micros(col) / F.lit(seconds * 1_000_000)) * F.lit(seconds)
    return F.timestamp_seconds(start).cast(dtype)


def to_local(col: Column, tz: str) -> Column:
    """Wall-clock time in a zone, as a timestamp without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col.cast("timestamp_ntz"))


def local_hour(col: Column, tz: str) -> Column:
    local = to_local(col, tz)
    return F.date_trunc("hour", local).cast("timestamp_ntz")


def local_date(col: Column, tz: str) -> Column:
    return F.to_date(to_local(col, tz))


def calendar_features(col: Column, tz: str) -> dict[str, Column]:
    """Hour and ISO weekday as text categories, and the weekend flag."""
    local = to_local(col, tz)
    return {
        "hour_of_day": F.date_format(local, "HH"),
        "day_of_week": (F.weekday(local) + F.lit(1)).cast("string"),
        "is_weekend": F.weekday(local) >= F.lit(5),
    }


def hour_aligned(as_of: datetime, lookback: timedelta) -> datetime:
    """The look-back start moved down to the full hour, so that every recomputed hour is complete."""
    return (as_of - lookback).replace(minute=0, second=0, microsecond=0)


def is_stale(generated_at: Column, as_of: Column, minutes: int = 60) -> Column:
    """True when a published document is older than the limit."""
    return (micros(as_of) - micros(generated_at)) > F.lit(minutes * 60_000_000)
