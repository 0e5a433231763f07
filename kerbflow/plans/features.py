"""Feature table and the choice of popular stations."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions.timefns import calendar_features, lit_like
from kerbflow.operators.lagfeatures import exact_lag, exact_lead, last_per_bucket

BUCKET_SECONDS = 1800
HORIZON_SECONDS = 3600


def station_features(fact: DataFrame, tz: str, bucket_seconds: int = BUCKET_SECONDS,
                     horizon_seconds: int = HORIZON_SECONDS, since: datetime | None = None,
                     tie: list[str] | None = None) -> DataFrame:
    """One row per station and bucket with trend, calendar and label columns.

    With `since`, four more buckets are read so that the first rows returned have their lags.
    """
    rows = fact.where(F.col("is_in_service") & F.col("bikes_available").isNotNull() & F.col("docks_available").isNotNull())
    if since is not None:
        read_from = since - timedelta(seconds=4 * bucket_seconds)
        rows = rows.where(F.col("source_updated_at") >= lit_like(rows, "source_updated_at", read_from))
    base = last_per_bucket(
        rows.select("station_uid", "source_updated_at", "bikes_available", "docks_available", *(tie or [])),
        "station_uid", "source_updated_at", bucket_seconds, tie)
    bikes, total = F.col("bikes_available"), F.col("bikes_available") + F.col("docks_available")
    at = ("station_uid", "bucket_ts", bikes)
    out = base.select(
        "station_uid",
        F.col("bucket_ts").alias("feature_ts"),
        (F.col("bucket_ts") + F.expr(f"INTERVAL {horizon_seconds} SECONDS")).alias("target_ts"),
        "bikes_available", "docks_available",
        total.alias("total_docks"),
        F.try_divide(bikes, total).alias("fill_ratio"),
        (bikes - exact_lag(*at, bucket_seconds)).alias("bikes_change_1"),
        (bikes - exact_lag(*at, 2 * bucket_seconds)).alias("bikes_change_2"),
        *[c.alias(n) for n, c in calendar_features(F.col("bucket_ts"), tz).items()],
        exact_lead(*at, horizon_seconds).alias("bikes_available_at_target"),
    )
    return out if since is None else out.where(F.col("feature_ts") >= lit_like(out, "feature_ts", since))


def popular_stations(features: DataFrame, n: int, as_of: datetime, span: timedelta = timedelta(days=7)) -> DataFrame:
    """The n stations with the most movement, ranked; ties by key."""
    recent = features.where(
        (F.col("feature_ts") >= lit_like(features, "feature_ts", as_of - span)) & F.col("bikes_change_1").isNotNull())
    moved = recent.groupBy("station_uid").agg(
        F.sum(F.abs("bikes_change_1")).alias("bikes_moved"), F.count(F.lit(1)).alias("observations"))
    order = [F.col("bikes_moved").desc(), F.col("station_uid").asc()]
    # The limit leaves n rows before the ranking orders them as one group.
    top = moved.orderBy(*order).limit(n)
    return top.withColumn("popularity_rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def complete(features: DataFrame) -> DataFrame:
    """Rows with all trend features, as used in training and in prediction."""
    return features.dropna(subset=["fill_ratio", "bikes_change_1", "bikes_change_2"])
