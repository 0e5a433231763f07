"""Fact table and hourly mart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.convert import round_to
from kerbflow.functions.timefns import lit_like, local_date, local_hour
from kerbflow.operators.dedupe import first_per_key
from kerbflow.sources.normalize import stage_observations

FACT_KEY = ["station_uid", "source_updated_at"]


def fact_availability(raw: DataFrame, tz: str) -> DataFrame:
    """One row per station and source time: the copy loaded first."""
    staged = stage_observations(raw)
    once = first_per_key(staged, FACT_KEY, ["ingested_at"])
    return once.withColumn("local_date", local_date(F.col("source_updated_at"), tz))


def store_bucketed(fact: DataFrame, name: str, path: str, buckets: int = 64) -> DataFrame:
    """The fact table as an external table bucketed and sorted by station, read back.

    Whatever groups, orders or joins by station, alone or with a time, then needs no exchange: features and the hourly mart
    are computed where the rows lie. A bucket is read by one task, so `buckets` must fit the table; stations that hold a
    large part of all rows are better served by the plain table.
    """
    (fact.hint("rebalance", "station_uid").write.mode("overwrite").bucketBy(buckets, "station_uid")
     .sortBy("station_uid", "source_updated_at").option("path", path).saveAsTable(name))
    return fact.sparkSession.table(name)


def station_hourly(fact: DataFrame, stations: DataFrame, tz: str, since: datetime | None = None) -> DataFrame:
    """Use of each station per local hour, in-service observations only.

    Rows are aggregated before the station names join in, so the join sees one row per station and hour. Of a dimension
    with versions the current ones give the names.
    """
    rows = fact.where(F.col("is_in_service"))
    if since is not None:
        rows = rows.where(F.col("source_updated_at") >= lit_like(rows, "source_updated_at", since))
    hourly = rows.groupBy("station_uid", local_hour(F.col("source_updated_at"), tz).alias("hour_local")).agg(
        F.count(F.lit(1)).alias("observations"),
        round_to(F.avg("bikes_available"), 2).alias("avg_bikes_available"),
        F.min("bikes_available").alias("min_bikes_available"),
        round_to(F.avg("docks_available"), 2).alias("avg_docks_available"),
        round_to(F.count_if(F.col("bikes_available") == 0) / F.count(F.lit(1)), 4).alias("empty_ratio"),
        round_to(F.count_if(F.col("docks_available") == 0) / F.count(F.lit(1)), 4).alias("full_ratio"),
    )
    if "is_current" in stations.columns:
        stations = stations.where("is_current")
    names = stations.select("station_uid", "station_name", "capacity", "lat", "lng")
    return hourly.join(names, "station_uid", "left").withColumn("local_date", F.to_date("hour_local"))
