"""The given tables seen as a bike-share feed: each view once as a DataFrame and once as SQL text.

All views cover their whole table. Arithmetic is on whole numbers up to the last step, so both engines agree.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.operators.dimension import dim_stations, scd2_from_log
from kerbflow.operators.transitions import status_events_batch
from kerbflow.plans.features import station_features
from kerbflow.plans.forecast import persistence_forecast
from kerbflow.plans.marts import fact_availability
from kerbflow.plans.serving import latest_availability, pending_forecast, snapshot
from kerbflow.session import prepare
from kerbflow.streaming.jobs import window_stats

TZ = "Asia/Taipei"
EVENTS_AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = datetime(2001, 8, 2)
BUCKET = 6 * 3600
HORIZON = 2 * BUCKET


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, the form in which the tables store them."""
    casts = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
             for f in df.schema.fields]
    return df.select(*casts)


def obs(spark: SparkSession, sf: str) -> DataFrame:
    bikes = F.least(F.floor(F.col("value") / 5), F.lit(20)).cast("bigint")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("station_uid"),
        F.col("ts").alias("source_updated_at"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).cast("bigint").alias("service_status"),
        bikes.alias("bikes_available"),
        (F.lit(20) - bikes).cast("bigint").alias("docks_available"),
        F.col("event_id").alias("seq"),
    )


def obs_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Every observation fetched twice, 5 and 35 minutes after its source time."""
    return obs(spark, sf).withColumn("__after", F.explode(F.array(F.lit(5), F.lit(35)))).withColumn(
        "ingested_at", F.col("source_updated_at") + F.make_interval(mins="__after")).drop("__after")


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact_availability(obs_raw(spark, sf), TZ)


def stations(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.cast("string").alias("station_uid"),
        F.col("c_name").alias("station_name"),
        (F.lit(24.0) + (key * 37 % 1000).cast("double") / F.lit(2000.0)).alias("lat"),
        (F.lit(120.5) + (key * 91 % 1000).cast("double") / F.lit(2000.0)).alias("lng"),
        F.lit(20).cast("bigint").alias("capacity"),
        F.col("c_nationkey").cast("bigint").alias("service_type"),
        F.lit(True).alias("is_current"),
    )


def station_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("station_uid"), F.col("o_orderdate").alias("seen_at"),
        F.col("o_orderkey").alias("seq"), "o_orderpriority", "o_orderstatus")


def capacity_log(spark: SparkSession, sf: str) -> DataFrame:
    """Capacity changes of stations during the month of the events."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("station_uid"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_interval(mins=(key * 37 % 43200).cast("int"))).alias("seen_at"),
        key.alias("seq"), (F.lit(15) + key % 8).cast("bigint").alias("capacity"))


def capacity_dim(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_from_log(capacity_log(spark, sf), "station_uid", "seen_at", ["capacity"], ["seq"])


def features(spark: SparkSession, sf: str) -> DataFrame:
    return station_features(fact(spark, sf), TZ, BUCKET, HORIZON, tie=None)


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return persistence_forecast(features(spark, sf))


def trend_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts that continue the last change, so that interpolation has something to do."""
    moved = F.col("bikes_available") + F.coalesce("bikes_change_1", F.lit(0))
    return features(spark, sf).select(
        "station_uid", "feature_ts", F.col("target_ts").alias("forecast_for"),
        F.least(F.greatest(moved, F.lit(0)), F.col("total_docks")).cast("double").alias("predicted_bikes_available"))


def status_events(spark: SparkSession, sf: str) -> DataFrame:
    return status_events_batch(obs(spark, sf), ["seq"])


def half_hours(spark: SparkSession, sf: str) -> DataFrame:
    return window_stats(obs(spark, sf))


def month(days: int = 31):
    from datetime import timedelta
    return timedelta(days=days)


def snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    latest = latest_availability(obs_raw(spark, sf), EVENTS_AS_OF, month())
    return snapshot(stations(spark, sf), latest, pending_forecast(trend_forecasts(spark, sf), EVENTS_AS_OF))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")

    def spot(base: float, factor: int):
        return F.lit(base) + (key * factor % 997).cast("double") / F.lit(2000.0)
    return table(spark, sf, "orders").select("o_orderkey").repartition(spark.sparkContext.defaultParallelism).select(
        key.alias("trip_id"), spot(24.0, 53).alias("origin_lat"), spot(120.5, 71).alias("origin_lng"),
        spot(24.0, 29).alias("dest_lat"), spot(120.5, 83).alias("dest_lng"))


def legs(spark: SparkSession, sf: str) -> DataFrame:
    """Known legs: rides between stations from lineitem, walks from trip origins to stations from orders."""
    from kerbflow.functions.geo import point_key

    places = stations(spark, sf).select("station_uid", point_key(F.col("lat"), F.col("lng")).alias("at"))
    ride = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("a"), F.col("l_partkey").cast("string").alias("b")).agg(
        F.min("l_quantity").alias("minutes"), F.min("l_extendedprice").alias("meters"))
    a, b = places.select(F.col("station_uid").alias("a"), F.col("at").alias("from_key")), places.select(
        F.col("station_uid").alias("b"), F.col("at").alias("to_key"))
    rides = ride.join(a, "a").join(b, "b").select(F.lit("ride").alias("profile"), "from_key", "to_key", "minutes", "meters")
    origins = trips(spark, sf).select("trip_id", point_key(F.col("origin_lat"), F.col("origin_lng")).alias("from_key"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").cast("string").alias("b"))
    walks = origins.join(orders, "trip_id").join(b, "b").select(
        F.lit("walk").alias("profile"), "from_key", "to_key", (F.col("trip_id") % 20 + 1).cast("double").alias("minutes"),
        F.lit(None).cast("double").alias("meters"))
    return rides.unionByName(walks)


def job_runs(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("job"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed")
        .otherwise("running").alias("state"),
        start.alias("due_at"), start.alias("started_at"),
        (start + F.make_interval(secs=(F.col("o_orderkey") % 3600).cast("decimal(18,6)"))).alias("ended_at"))


def metric_samples(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("metric"), F.col("user_id").cast("string").alias("series"), "ts", "value")


# ---- the same views as SQL -------------------------------------------------------------------------------------

def sql_haversine(a_lat: str, a_lng: str, b_lat: str, b_lng: str) -> str:
    return (f"12742000.0 * asin(sqrt(least(1.0, pow(sin(radians({b_lat} - {a_lat}) / 2), 2) + cos(radians({a_lat})) * "
            f"cos(radians({b_lat})) * pow(sin(radians({b_lng} - {a_lng}) / 2), 2))))")


def sql_round(x: str, digits: int) -> str:
    scale = float(10**digits)
    return f"floor(({x}) * {scale!r}::DOUBLE + 0.5::DOUBLE) / {scale!r}::DOUBLE"


def sql_key(lat: str, lng: str) -> str:
    return (f"CAST(floor({lat} * 100000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) * 100000000 + "
            f"CAST(floor({lng} * 100000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)")


def sql_bucket(ts: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


_SPOT = "CAST({base} AS DOUBLE) + CAST(o_orderkey * {f} % 997 AS DOUBLE) / CAST(2000.0 AS DOUBLE)"

CTES = {
    "obs": """
      SELECT CAST(user_id AS VARCHAR) AS station_uid, ts AS source_updated_at,
             CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS BIGINT) AS service_status,
             CAST(least(floor(value / 5), 20) AS BIGINT) AS bikes_available,
             20 - CAST(least(floor(value / 5), 20) AS BIGINT) AS docks_available, event_id AS seq
      FROM events""",
    "obs_raw": """
      SELECT obs.*, source_updated_at + INTERVAL 1 MINUTE * d.after AS ingested_at
      FROM obs CROSS JOIN (VALUES (5), (35)) AS d(after)""",
    "fact": """
      SELECT station_uid, source_updated_at, service_status, bikes_available, docks_available, seq, ingested_at,
             service_status = 1 AS is_in_service, CAST(source_updated_at + INTERVAL 8 HOUR AS DATE) AS local_date
      FROM obs_raw
      QUALIFY row_number() OVER (PARTITION BY station_uid, source_updated_at ORDER BY ingested_at) = 1""",
    "stations": """
      SELECT CAST(c_custkey AS VARCHAR) AS station_uid, c_name AS station_name,
             CAST(24.0 AS DOUBLE) + CAST(c_custkey * 37 % 1000 AS DOUBLE) / CAST(2000.0 AS DOUBLE) AS lat,
             CAST(120.5 AS DOUBLE) + CAST(c_custkey * 91 % 1000 AS DOUBLE) / CAST(2000.0 AS DOUBLE) AS lng,
             CAST(20 AS BIGINT) AS capacity, CAST(c_nationkey AS BIGINT) AS service_type, true AS is_current
      FROM customer""",
    "station_log": """
      SELECT CAST(o_custkey AS VARCHAR) AS station_uid, o_orderdate AS seen_at, o_orderkey AS seq,
             o_orderpriority, o_orderstatus
      FROM orders""",
    "capacity_log": """
      SELECT CAST(o_custkey AS VARCHAR) AS station_uid,
             TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * CAST(o_orderkey * 37 % 43200 AS INTEGER) AS seen_at,
             o_orderkey AS seq, CAST(15 + o_orderkey % 8 AS BIGINT) AS capacity
      FROM orders""",
    "capacity_dim": """
      SELECT station_uid, capacity, seen_at AS valid_from,
             lead(seen_at) OVER (PARTITION BY station_uid ORDER BY seen_at, seq) AS valid_to
      FROM (SELECT *, lag(capacity) OVER (PARTITION BY station_uid ORDER BY seen_at, seq) AS before FROM capacity_log)
      WHERE before IS NULL OR before <> capacity""",
    "binned": f"""
      SELECT station_uid, {sql_bucket('source_updated_at', BUCKET)} AS b, bikes_available, docks_available
      FROM fact WHERE is_in_service
      QUALIFY row_number() OVER (PARTITION BY station_uid, b ORDER BY source_updated_at DESC) = 1""",
    "features": f"""
      SELECT c.station_uid, c.b AS feature_ts, c.b + INTERVAL {HORIZON} SECOND AS target_ts,
             c.bikes_available, c.docks_available, c.bikes_available + c.docks_available AS total_docks,
             c.bikes_available / nullif(c.bikes_available + c.docks_available, 0) AS fill_ratio,
             c.bikes_available - l1.bikes_available AS bikes_change_1,
             c.bikes_available - l2.bikes_available AS bikes_change_2,
             strftime(c.b + INTERVAL 8 HOUR, '%H') AS hour_of_day,
             CAST(isodow(c.b + INTERVAL 8 HOUR) AS VARCHAR) AS day_of_week,
             isodow(c.b + INTERVAL 8 HOUR) >= 6 AS is_weekend,
             t.bikes_available AS bikes_available_at_target
      FROM binned c
      LEFT JOIN binned l1 ON l1.station_uid = c.station_uid AND l1.b = c.b - INTERVAL {BUCKET} SECOND
      LEFT JOIN binned l2 ON l2.station_uid = c.station_uid AND l2.b = c.b - INTERVAL {2 * BUCKET} SECOND
      LEFT JOIN binned t ON t.station_uid = c.station_uid AND t.b = c.b + INTERVAL {HORIZON} SECOND""",
    "forecasts": """
      SELECT station_uid, feature_ts, target_ts AS forecast_for, bikes_available AS bikes_available_now, total_docks,
             CAST(bikes_available AS DOUBLE) AS predicted_bikes_available
      FROM features""",
    "trend_forecasts": """
      SELECT station_uid, feature_ts, target_ts AS forecast_for,
             CAST(least(greatest(bikes_available + coalesce(bikes_change_1, 0), 0), total_docks) AS DOUBLE)
               AS predicted_bikes_available
      FROM features""",
    "classified": """
      SELECT *, CASE WHEN service_status IS DISTINCT FROM 1 THEN 'out_of_service' WHEN bikes_available = 0 THEN 'empty'
                     WHEN docks_available = 0 THEN 'full' ELSE 'normal' END AS status
      FROM obs QUALIFY row_number() OVER (PARTITION BY station_uid, source_updated_at ORDER BY seq) = 1""",
    "changes": """
      SELECT * FROM (SELECT *, lag(status) OVER (PARTITION BY station_uid ORDER BY source_updated_at) AS before
                     FROM classified)
      WHERE before IS DISTINCT FROM status""",
    "status_events": """
      SELECT station_uid, status, previous_status, source_updated_at AS changed_at,
             CAST(floor((epoch_us(source_updated_at) - epoch_us(since)) / 1000000) AS BIGINT)
               AS previous_duration_seconds,
             bikes_available, docks_available
      FROM (SELECT *, lag(status) OVER w AS previous_status, lag(source_updated_at) OVER w AS since
            FROM changes WINDOW w AS (PARTITION BY station_uid ORDER BY source_updated_at))
      WHERE previous_status IS NOT NULL OR status <> 'normal'""",
    "half_hours": f"""
      SELECT station_uid, {sql_bucket('source_updated_at', 1800)} AS window_start,
             {sql_bucket('source_updated_at', 1800)} + INTERVAL 30 MINUTE AS window_end,
             count(*) AS observations,
             {sql_round('avg(bikes_available)', 2)} AS avg_bikes_available,
             min(bikes_available) AS min_bikes_available, max(bikes_available) AS max_bikes_available,
             {sql_round('avg(docks_available)', 2)} AS avg_docks_available,
             count(*) FILTER (WHERE bikes_available = 0) AS empty_observations,
             count(*) FILTER (WHERE docks_available = 0) AS full_observations
      FROM obs WHERE service_status = 1 GROUP BY 1, 2, 3""",
    "latest_obs": """
      SELECT * FROM obs_raw
      WHERE ingested_at >= TIMESTAMP '2024-01-31' - INTERVAL 31 DAY
      QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY source_updated_at DESC, ingested_at DESC) = 1""",
    "pending": """
      SELECT station_uid, forecast_for, predicted_bikes_available FROM trend_forecasts
      WHERE forecast_for > TIMESTAMP '2024-01-31' AND forecast_for < TIMESTAMP '2024-02-01'
      QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY feature_ts DESC) = 1""",
    "snapshot_rows": """
      SELECT s.station_uid, s.station_name, s.lat, s.lng, a.bikes_available, a.docks_available,
             a.service_status IS NOT DISTINCT FROM 1 AS is_in_service, a.source_updated_at,
             p.forecast_for, p.predicted_bikes_available
      FROM stations s JOIN latest_obs a USING (station_uid) LEFT JOIN pending p USING (station_uid)""",
    "trips": f"""
      SELECT o_orderkey AS trip_id, {_SPOT.format(base=24.0, f=53)} AS origin_lat,
             {_SPOT.format(base=120.5, f=71)} AS origin_lng, {_SPOT.format(base=24.0, f=29)} AS dest_lat,
             {_SPOT.format(base=120.5, f=83)} AS dest_lng
      FROM orders""",
    "legs": f"""
      SELECT 'ride' AS profile, {sql_key('a.lat', 'a.lng')} AS from_key, {sql_key('b.lat', 'b.lng')} AS to_key,
             r.minutes, r.meters
      FROM (SELECT CAST(l_suppkey AS VARCHAR) AS a, CAST(l_partkey AS VARCHAR) AS b, min(l_quantity) AS minutes,
                   min(l_extendedprice) AS meters FROM lineitem GROUP BY 1, 2) r
      JOIN stations a ON a.station_uid = r.a JOIN stations b ON b.station_uid = r.b
      UNION ALL
      SELECT 'walk', {sql_key('t.origin_lat', 't.origin_lng')}, {sql_key('b.lat', 'b.lng')},
             CAST(t.trip_id % 20 + 1 AS DOUBLE), CAST(NULL AS DOUBLE)
      FROM trips t JOIN orders o ON o.o_orderkey = t.trip_id
      JOIN stations b ON b.station_uid = CAST(o.o_custkey AS VARCHAR)""",
    "job_runs": """
      SELECT o_orderpriority AS job,
             CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS state,
             o_orderdate AS due_at, o_orderdate AS started_at,
             o_orderdate + INTERVAL 1 SECOND * CAST(o_orderkey % 3600 AS INTEGER) AS ended_at
      FROM orders""",
    "metric_samples": """
      SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS series, ts, value FROM events""",
}


def oracle(body: str, **extra: str) -> str:
    """The body behind the views it names, directly or through others."""
    import re

    ctes = {**CTES, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in ctes.items():
            if name not in needed and re.search(rf"\b{name}\b", text) and view is not text:
                visit(view)
                if name not in needed:
                    needed.append(name)

    visit(body)
    head = ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in needed)
    return f"WITH {head}\n{body.strip()}" if needed else body.strip()
