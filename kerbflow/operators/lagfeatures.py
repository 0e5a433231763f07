"""Gap-aware time-bucket features.

After `last_per_bucket` a station has at most one row per bucket, so the window over a station is bounded by the
time span divided by the bucket length, however many raw rows the station has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions.timefns import bucket
from kerbflow.operators.dedupe import latest_per_key


def last_per_bucket(df: DataFrame, key: str, ts: str, seconds: int, tie: list[str] | None = None) -> DataFrame:
    """Last row of each key and time bucket; the bucket start is added as `bucket_ts`."""
    dtype = df.schema[ts].dataType.simpleString()
    placed = df.withColumn("bucket_ts", bucket(F.col(ts), seconds, dtype))
    return latest_per_key(placed, [key, "bucket_ts"], [ts, *(tie or [])])


def exact_offset(key: str, ts: str, value: Column, seconds: int) -> Column:
    """Value exactly `seconds` later (earlier when negative) in the same key, null when that instant is missing.

    A range frame of a single instant: unlike `lag` it never falls back to an older row, and all offsets share one
    sort where self joins would need a shuffle each.
    """
    epoch = F.unix_timestamp(F.col(ts).cast("timestamp"))
    return F.first(value).over(Window.partitionBy(key).orderBy(epoch).rangeBetween(seconds, seconds))


def exact_lag(key: str, ts: str, value: Column, seconds: int) -> Column:
    return exact_offset(key, ts, value, -seconds)


def exact_lead(key: str, ts: str, value: Column, seconds: int) -> Column:
    return exact_offset(key, ts, value, seconds)
