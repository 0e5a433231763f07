"""The current-status snapshot."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.convert import display_name, round_to
from kerbflow.functions.timefns import lit_like
from kerbflow.operators.dedupe import latest_per_key
from kerbflow.schemas import FORECAST


def latest_availability(raw: DataFrame, as_of: datetime, max_age: timedelta = timedelta(minutes=60)) -> DataFrame:
    """Newest usable observation of each station among recent loads."""
    recent = ((F.col("ingested_at") >= lit_like(raw, "ingested_at", as_of - max_age))
              & F.col("bikes_available").isNotNull() & F.col("docks_available").isNotNull())
    return latest_per_key(raw, ["station_uid"], ["source_updated_at", "ingested_at"], recent)


def pending_forecast(forecasts: DataFrame, as_of: datetime, within: timedelta = timedelta(days=1)) -> DataFrame:
    """Newest forecast of each station that is not due yet."""
    due = F.col("forecast_for")
    open_ = (due > lit_like(forecasts, "forecast_for", as_of)) & (due < lit_like(forecasts, "forecast_for", as_of + within))
    return latest_per_key(forecasts, ["station_uid"], ["feature_ts"], open_).select(
        "station_uid", "forecast_for", "predicted_bikes_available")


def snapshot(stations: DataFrame, availability: DataFrame, forecasts: DataFrame | None = None) -> DataFrame:
    """Current stations with position and status, and a forecast where there is one.

    Before a first training there is no forecast table: `None` gives null forecasts.
    """
    if forecasts is None:
        empty = stations.sparkSession.createDataFrame([], FORECAST)
        forecasts = empty.select("station_uid", "forecast_for", "predicted_bikes_available")
    placed = stations.where(F.col("is_current") & F.col("lat").isNotNull() & F.col("lng").isNotNull())
    status = availability.select(
        "station_uid", "bikes_available", "docks_available", (F.col("service_status").eqNullSafe(1)).alias("is_in_service"),
        "source_updated_at")
    return placed.select("station_uid", "station_name", "lat", "lng").join(status, "station_uid").join(
        forecasts, "station_uid", "left")


def iso_utc(col: Column) -> Column:
    return F.date_format(col.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def snapshot_payload(rows: DataFrame, prefix: str) -> DataFrame:
    """Published form of each station: short names, five decimals, forecast only when it is complete."""
    forecast = F.struct(iso_utc(F.col("forecast_for")).alias("at"),
                        round_to(F.col("predicted_bikes_available"), 1).alias("bikes"))
    return rows.select(
        F.col("station_uid").alias("id"), display_name(F.col("station_name"), prefix).alias("name"),
        round_to(F.col("lat"), 5).alias("lat"), round_to(F.col("lng"), 5).alias("lng"),
        F.col("bikes_available").cast("long").alias("bikes"), F.col("docks_available").cast("long").alias("docks"),
        F.col("is_in_service").alias("in_service"),
        F.when(F.col("forecast_for").isNotNull() & F.col("predicted_bikes_available").isNotNull(), forecast).alias("forecast"))
