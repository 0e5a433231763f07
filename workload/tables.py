"""Sources, merges, normalisation, dedupe, dimensions and the hourly mart (A, B, C)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.functions.convert import display_name, to_double, to_int, to_utc
from kerbflow.functions.timefns import bucket, hour_aligned, lit_like, local_date, local_hour
from kerbflow.operators.dedupe import first_per_key, latest_per_key
from kerbflow.operators.dimension import asof_dim_join, dim_stations, scd2_apply, scd2_from_log
from kerbflow.operators.merge import (
    commit_seen, incremental_slice, insert_new, merge_incremental, select_changed, upsert,
)
from kerbflow.plans.marts import station_hourly
from kerbflow.schemas import AVAILABILITY_FIELDS, RAW_AVAILABILITY, STAGED_AVAILABILITY
from kerbflow.session import scratch_dir, store
from kerbflow.sources.landing import append_raw, land, newest_batch, read_raw_table, read_staged, recent_days
from kerbflow.sources.normalize import field_presence, normalize, read_records, stage_observations, station_rows
from kerbflow.sources.tables import KeyedTable
from kerbflow.streaming.jobs import station_table
from workload import views as v
from workload.registry import query
from workload.views import EVENTS_AS_OF, TZ, sql_round

CUT = datetime(2024, 1, 16)
OVERLAP = datetime(2024, 1, 10)


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw nested records: numbers partly as text, local times with offset, detail often absent."""
    obs = v.obs(spark, sf)
    local = F.date_format(F.col("source_updated_at") + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    detail = F.struct(F.col("bikes_available").alias("GeneralBikes"), F.lit(0).alias("ElectricBikes"))
    body = F.to_json(F.struct(
        F.col("station_uid").alias("StationUID"), F.lit(2).alias("ServiceType"),
        F.col("service_status").alias("ServiceStatus"), F.col("bikes_available").alias("AvailableRentBikes"),
        F.col("docks_available").cast("string").alias("AvailableReturnBikes"),
        F.when(F.col("service_status") == 1, detail).alias("AvailableRentBikesDetail"),
        F.concat(local, F.lit("+08:00")).alias("SrcUpdateTime"), F.lit("not a time").alias("UpdateTime")))
    return obs.select(F.from_json(body, RAW_AVAILABILITY).alias("r"), (
        F.col("source_updated_at").cast("timestamp") + F.expr("INTERVAL 5 MINUTES")).alias("ingested_at")).select("r.*", "ingested_at")


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(raw_records(spark, sf), AVAILABILITY_FIELDS, "Testville")


STAGED_SQL = """
    SELECT station_uid, CAST(NULL AS VARCHAR) AS station_id, CAST(2 AS BIGINT) AS service_type, service_status,
           bikes_available, docks_available,
           CASE WHEN service_status = 1 THEN bikes_available END AS general_bikes_available,
           CASE WHEN service_status = 1 THEN CAST(0 AS BIGINT) END AS ebikes_available,
           source_updated_at, CAST(NULL AS TIMESTAMP) AS api_updated_at, 'Testville' AS city,
           source_updated_at + INTERVAL 5 MINUTE AS ingested_at
    FROM obs"""


@query("b1_normalize", STAGED_SQL)
def b1(spark, sf):
    return staged(spark, sf)


@query("a2_landing_read_back", """
    SELECT strftime(ingested_at + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt,
           CAST(strftime(ingested_at + INTERVAL 8 HOUR, '%H') AS INTEGER) AS hour,
           count(*) AS n, CAST(sum(bikes_available) AS BIGINT) AS bikes, count(general_bikes_available) AS detailed,
           max(source_updated_at) AS newest
    FROM staged GROUP BY 1, 2""", staged=STAGED_SQL)
def a2(spark, sf):
    """Staged rows landed as NDJSON in the directory layout and read back."""
    root = scratch_dir(spark, "landing")
    land(staged(spark, sf), root, "bike_availability", TZ)
    back = read_staged(spark, f"{root}/staged/bike_availability", STAGED_AVAILABILITY)
    return back.groupBy(F.col("dt").cast("string").alias("dt"), F.col("hour").cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bikes_available").alias("bikes"),
        F.count("general_bikes_available").alias("detailed"), F.max("source_updated_at").alias("newest"))


@query("a4_recent_days", """
    SELECT station_uid, source_updated_at, bikes_available FROM staged
    WHERE CAST(ingested_at + INTERVAL 8 HOUR AS DATE) IN (DATE '2024-01-30', DATE '2024-01-29')""", staged=STAGED_SQL)
def a4(spark, sf):
    root = scratch_dir(spark, "landing")
    land(staged(spark, sf), root, "bike_availability", TZ)
    back = read_staged(spark, f"{root}/staged/bike_availability", STAGED_AVAILABILITY)
    return recent_days(back, datetime(2024, 1, 30, 12), TZ).select("station_uid", "source_updated_at", "bikes_available")


@query("a5_newest_of_three_loads", """
    SELECT station_uid, source_updated_at, bikes_available FROM staged WHERE source_updated_at < TIMESTAMP '2024-01-11'""", staged=STAGED_SQL)
def a5(spark, sf):
    """Three loads of which the last one written to the oldest directories has the newest stamp."""
    # Parsed once, not once a load.
    root, rows = scratch_dir(spark, "landing"), store(staged(spark, sf), "parsed")
    at = F.col("source_updated_at")
    bounds = [lit_like(rows, "source_updated_at", datetime(2024, 1, d)) for d in (11, 21)]
    for i, part in enumerate([at >= bounds[1], (at >= bounds[0]) & (at < bounds[1]), at < bounds[0]]):
        land(rows.where(part), root, "bike_availability", TZ, datetime(2024, 2, 1, i))
    back = read_staged(spark, f"{root}/staged/bike_availability", STAGED_AVAILABILITY)
    return newest_batch(back).select("station_uid", "source_updated_at", "bikes_available")


@query("a6_append_raw_table", """
    SELECT CAST(ingested_at AS DATE) AS ingest_date, count(*) AS n, CAST(sum(bikes_available) AS BIGINT) AS bikes
    FROM obs_raw WHERE ingested_at >= TIMESTAMP '2024-01-16' GROUP BY 1""")
def a6(spark, sf):
    """Two appends, then a read of the second half of the month that prunes directories."""
    path = scratch_dir(spark, "raw")
    raw = v.obs_raw(spark, sf)
    append_raw(raw.where(F.col("ingested_at") < lit_like(raw, "ingested_at", CUT)), path)
    append_raw(raw.where(F.col("ingested_at") >= lit_like(raw, "ingested_at", CUT)), path)
    return read_raw_table(spark, path, CUT).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bikes_available").alias("bikes"))


LATEST_BOTH = """
    SELECT station_uid, source_updated_at, service_status, bikes_available, docks_available FROM obs
    QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY source_updated_at DESC) = 1"""


@query("b2_field_presence", """
    SELECT field, present, count(*) OVER () * 0 + (SELECT count(*) FROM events) AS records FROM (
        SELECT 'StationUID' AS field, (SELECT count(*) FROM events) AS present
        UNION ALL SELECT 'ServiceStatus', (SELECT count(*) FROM events)
        UNION ALL SELECT 'AvailableRentBikesDetail.ElectricBikes', (SELECT count(*) FROM events WHERE event_type <> 'error')
        UNION ALL SELECT 'UpdateTime', 0)""")
def b2_presence(spark, sf):
    """Raw responses, one a station: a field that is null in every record is there, one that no record has is not."""
    root = scratch_dir(spark, "raw")
    seen = v.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("StationUID"), "event_type")
    closed = F.col("event_type") == "error"
    base = [F.col("StationUID"), F.lit(None).cast("string").alias("ServiceStatus")]
    detail = F.struct(F.lit(1).alias("ElectricBikes")).alias("AvailableRentBikesDetail")
    whole = {"ignoreNullFields": "false"}
    record = F.when(closed, F.to_json(F.struct(*base), whole)).otherwise(F.to_json(F.struct(*base, detail), whole))
    (seen.withColumn("record", record).groupBy("StationUID")
     .agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value")).select("value").write.text(root))
    return field_presence(read_records(spark, root, lines=True), ("StationUID", "ServiceStatus", "AvailableRentBikesDetail.ElectricBikes", "UpdateTime"))


def _halves(spark, sf):
    obs = v.obs(spark, sf).drop("seq")
    cut = lit_like(obs, "source_updated_at", CUT)
    return obs.where(F.col("source_updated_at") < cut), obs.where(F.col("source_updated_at") >= cut)


@query("a8_upsert", LATEST_BOTH)
def a8(spark, sf):
    """Latest status per station of the first half month, then the second half upserted."""
    early, late = _halves(spark, sf)
    target = latest_per_key(early, ["station_uid"], ["source_updated_at"])
    return upsert(target, late, ["station_uid"], order=["source_updated_at"])


@query("a8_upsert_stored_table", LATEST_BOTH)
def a8_stored(spark, sf):
    """The same through a stored table; the second batch runs twice, as after a failure."""
    early, late = _halves(spark, sf)
    root = scratch_dir(spark, "table")
    table = KeyedTable(spark, f"{root}/t", early.schema, ["station_uid"])
    for i, batch in enumerate([early, late, late]):
        table.upsert(batch, order=["source_updated_at"])
    return table.read()


@query("a9_insert_new", "SELECT * FROM status_events")
def a9(spark, sf):
    """Events of two overlapping spans: the second insert adds only the absent ones."""
    events = v.status_events(spark, sf)
    at = F.col("changed_at")
    first = events.where(at < lit_like(events, "changed_at", CUT))
    second = events.where(at >= lit_like(events, "changed_at", OVERLAP))
    return insert_new(first, second, ["station_uid", "changed_at"])


@query("a10_insert_forecasts_bounded", """
    SELECT station_uid, feature_ts, forecast_for, predicted_bikes_available FROM trend_forecasts
    WHERE feature_ts < TIMESTAMP '2024-01-16'
    UNION ALL
    SELECT station_uid, feature_ts, forecast_for, predicted_bikes_available + 1 FROM trend_forecasts
    WHERE feature_ts >= TIMESTAMP '2024-01-16'""")
def a10(spark, sf):
    """Forecasts made again with another value change nothing; new ones are added."""
    made = v.trend_forecasts(spark, sf)
    stored = made.where(F.col("feature_ts") < lit_like(made, "feature_ts", CUT))
    again = made.where(F.col("feature_ts") >= lit_like(made, "feature_ts", CUT - timedelta(days=1))).withColumn(
        "predicted_bikes_available", F.col("predicted_bikes_available") + 1)
    return insert_new(stored, again, ["station_uid", "feature_ts"],
                      target_filter=F.col("forecast_for") >= lit_like(stored, "forecast_for", CUT - timedelta(days=1)))


def _merge_parts(spark, sf):
    raw = stage_observations(v.obs_raw(spark, sf))
    loaded = F.col("ingested_at")
    target = first_per_key(raw.where(loaded < lit_like(raw, "ingested_at", CUT)), ["station_uid", "source_updated_at"], ["ingested_at"])
    part = incremental_slice(raw, target, "ingested_at", "source_updated_at", timedelta(hours=3), timedelta(days=20), EVENTS_AS_OF)
    return raw, target, part


STORED = """
    SELECT station_uid, source_updated_at, min(ingested_at) AS first_load FROM obs_raw
    WHERE ingested_at < TIMESTAMP '2024-01-16' GROUP BY 1, 2"""
MERGE_COLUMNS = ["station_uid", "source_updated_at", "ingested_at", "bikes_available", "is_in_service"]


@query("c3_incremental_slice", """
    SELECT station_uid, source_updated_at, ingested_at FROM obs_raw
    WHERE ingested_at >= (SELECT max(first_load) FROM stored) - INTERVAL 3 HOUR
      AND source_updated_at >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""", stored=STORED)
def c3(spark, sf):
    return _merge_parts(spark, sf)[2].select("station_uid", "source_updated_at", "ingested_at")


@query("a11_merge_keep", """
    SELECT station_uid, source_updated_at, ingested_at, bikes_available, is_in_service FROM fact
    WHERE source_updated_at >= TIMESTAMP '2024-01-11'""")
def a11_keep(spark, sf):
    """Full build of the first half plus one increment equals the full build of everything (recent part)."""
    _, target, part = _merge_parts(spark, sf)
    batch = first_per_key(part, ["station_uid", "source_updated_at"], ["ingested_at"])
    return merge_incremental(target, batch, ["station_uid", "source_updated_at"], "source_updated_at",
                             EVENTS_AS_OF - timedelta(days=20)).select(*MERGE_COLUMNS)


@query("a11_merge_update", """
    SELECT station_uid, source_updated_at, min(ingested_at) AS ingested_at, any_value(bikes_available) AS bikes_available,
           any_value(service_status) = 1 AS is_in_service
    FROM obs_raw
    WHERE source_updated_at >= TIMESTAMP '2024-01-11'
      AND (ingested_at >= (SELECT max(first_load) FROM stored) - INTERVAL 3 HOUR
           OR source_updated_at + INTERVAL 35 MINUTE < (SELECT max(first_load) FROM stored) - INTERVAL 3 HOUR)
    GROUP BY 1, 2""", stored=STORED)
def a11_update(spark, sf):
    """With `update`, a repeat fetch inside the look-back replaces the stored row and its load time."""
    _, target, part = _merge_parts(spark, sf)
    batch = first_per_key(part, ["station_uid", "source_updated_at"], ["ingested_at"])
    return merge_incremental(target, batch, ["station_uid", "source_updated_at"], "source_updated_at",
                             EVENTS_AS_OF - timedelta(days=20), when_matched="update").select(*MERGE_COLUMNS)


@query("a11_merge_stored_table", """
    SELECT CAST(source_updated_at AS DATE) AS day, count(*) AS n, max(ingested_at) AS newest FROM fact GROUP BY 1""")
def a11_stored(spark, sf):
    """Three overlapping increments into a day-partitioned table; only touched days are rewritten."""
    raw = v.obs_raw(spark, sf)
    root = scratch_dir(spark, "fact")
    table = KeyedTable(spark, f"{root}/t", raw.schema, ["station_uid", "source_updated_at"], day_of="source_updated_at")
    at = F.col("ingested_at")
    bounds = [datetime(2024, 1, 1), OVERLAP, CUT, datetime(2024, 2, 2)]
    for i in range(3):
        lo, hi = bounds[i] - timedelta(days=1), bounds[i + 1]
        batch = raw.where((at >= lit_like(raw, "ingested_at", lo)) & (at < lit_like(raw, "ingested_at", hi)))
        table.insert_new(batch, order=["ingested_at"])
    return table.read().groupBy(F.to_date("source_updated_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("newest"))


@query("a12_merge_new_column", """
    SELECT station_uid, source_updated_at, bikes_available,
           CASE WHEN source_updated_at >= TIMESTAMP '2024-01-16' THEN docks_available END AS docks_available FROM obs""")
def a12(spark, sf):
    early, late = _halves(spark, sf)
    names = ["station_uid", "source_updated_at", "bikes_available"]
    return insert_new(early.select(*names), late.select(*names, "docks_available"), names[:2], evolve=True)


SEEN = "SELECT station_uid, max(source_updated_at) AS source_updated_at FROM obs WHERE source_updated_at < TIMESTAMP '2024-01-16' GROUP BY 1"


@query("a13_select_changed", """
    SELECT o.station_uid, o.source_updated_at, o.seq FROM obs o LEFT JOIN seen s ON s.station_uid = o.station_uid
    WHERE s.station_uid IS NULL OR o.source_updated_at > s.source_updated_at""", seen=SEEN)
def a13(spark, sf):
    early, _ = _halves(spark, sf)
    seen = early.groupBy("station_uid").agg(F.max("source_updated_at").alias("source_updated_at"))
    return select_changed(v.obs(spark, sf), seen, "station_uid", "source_updated_at").select(
        "station_uid", "source_updated_at", "seq")


@query("a14_commit_seen", """
    SELECT station_uid, max(source_updated_at) AS source_updated_at FROM obs
    WHERE source_updated_at < TIMESTAMP '2024-01-16' OR service_status = 1 GROUP BY 1""")
def a14(spark, sf):
    """Only delivered rows (here the in-service ones) move the mark of their key."""
    early, late = _halves(spark, sf)
    seen = early.groupBy("station_uid").agg(F.max("source_updated_at").alias("source_updated_at"))
    sent = select_changed(late, seen, "station_uid", "source_updated_at").where("service_status = 1")
    return commit_seen(seen, sent, "station_uid", "source_updated_at")


def _sql_int(x: str) -> str:
    return f"CASE WHEN TRY_CAST({x} AS DOUBLE) = floor(TRY_CAST({x} AS DOUBLE)) THEN CAST(TRY_CAST({x} AS DOUBLE) AS BIGINT) END"


@query("b3_coerce_numbers", f"""
    SELECT event_id, {_sql_int("CAST(value AS VARCHAR)")} AS whole, {_sql_int("event_type")} AS bad,
           {_sql_int("regexp_extract(props, '([0-9]+)', 1)")} AS from_text,
           TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS real, TRY_CAST(event_type AS DOUBLE) AS bad_real
    FROM events""")
def b3(spark, sf):
    events = v.table(spark, sf, "events")
    return events.select(
        "event_id", to_int(F.col("value")).alias("whole"), to_int(F.col("event_type")).alias("bad"),
        to_int(F.regexp_extract("props", "([0-9]+)", 1)).alias("from_text"),
        to_double(F.col("value")).alias("real"), to_double(F.col("event_type")).alias("bad_real"))


@query("b4_coerce_times", """
    SELECT event_id, ts AS good, CAST(NULL AS TIMESTAMP) AS bad,
           CAST(date_trunc('second', ts) AS TIMESTAMP) - INTERVAL 3 HOUR AS shifted FROM events""")
def b4(spark, sf):
    events = v.table(spark, sf, "events")
    return events.select(
        "event_id", to_utc(F.col("ts").cast("string")).alias("good"), to_utc(F.col("event_type")).alias("bad"),
        to_utc(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))).alias("shifted"))


@query("b8_station_rows", """
    SELECT station_uid, regexp_replace(station_name, '^Customer#', '') AS station_name, lat, lng,
           CAST(capacity AS INTEGER) AS capacity FROM stations""")
def b9(spark, sf):
    return station_rows(v.stations(spark, sf), "Customer#")


@query("b9_stations_table", """
    SELECT station_uid, regexp_replace(station_name, '^Customer#', '') AS station_name, lat, lng,
           CAST(capacity AS INTEGER) AS capacity FROM stations""")
def b9_table(spark, sf):
    """Reference rows upserted into the stations table; the second load brings their names."""
    root = scratch_dir(spark, "stations")
    table = station_table(spark, f"{root}/t")
    stations = v.stations(spark, sf)
    table.upsert(station_rows(stations.withColumn("station_name", F.lit("old")), "Customer#"))
    table.upsert(station_rows(stations, "Customer#"))
    return table.read().drop("updated_at")


@query("b8_display_name", """
    SELECT p_partkey, CASE WHEN starts_with(p_name, 'small ') THEN substr(p_name, 7) ELSE coalesce(p_name, '') END AS name
    FROM part""")
def b8(spark, sf):
    return v.table(spark, sf, "part").select("p_partkey", display_name(F.col("p_name"), "small ").alias("name"))


@query("b10_stage_observations", """
    SELECT station_uid, source_updated_at, service_status, service_status = 1 AS is_in_service, bikes_available
    FROM obs_raw WHERE station_uid IS NOT NULL AND source_updated_at IS NOT NULL""")
def b10(spark, sf):
    return stage_observations(v.obs_raw(spark, sf)).select(
        "station_uid", "source_updated_at", "service_status", "is_in_service", "bikes_available")


@query("c1_fact_dedupe", """
    SELECT station_uid, source_updated_at, bikes_available, docks_available, is_in_service, ingested_at, local_date FROM fact""")
def c1(spark, sf):
    return v.fact(spark, sf).select("station_uid", "source_updated_at", "bikes_available", "docks_available",
                                    "is_in_service", "ingested_at", "local_date")


@query("c1_first_line_per_order", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey,
                               l_extendedprice) = 1""")
def c1_lines(spark, sf):
    """The dedupe on the largest table."""
    lines = v.table(spark, sf, "lineitem")
    return first_per_key(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
                         ).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")


@query("c2_latest_in_horizon", """
    SELECT station_uid, o_orderpriority, o_orderstatus, seen_at, seq FROM station_log
    WHERE seen_at >= TIMESTAMP '2001-08-02' - INTERVAL 365 DAY
    QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY seen_at DESC, seq DESC) = 1""")
def c2(spark, sf):
    log = v.station_log(spark, sf)
    recent = F.col("seen_at") >= lit_like(log, "seen_at", v.ORDERS_AS_OF - timedelta(days=365))
    return latest_per_key(log, ["station_uid"], ["seen_at", "seq"], recent)


@query("c4_local_time", """
    SELECT event_id, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_date,
           CAST(date_trunc('hour', ts + INTERVAL 8 HOUR) AS TIMESTAMP) AS local_hour FROM events""")
def c4(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", local_date(F.col("ts"), TZ).alias("local_date"), local_hour(F.col("ts"), TZ).alias("local_hour"))


SCD2_LOG = """
    SELECT station_uid, o_orderpriority, seen_at AS valid_from,
           lead(seen_at) OVER (PARTITION BY station_uid ORDER BY seen_at, seq) AS valid_to
    FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY station_uid ORDER BY seen_at, seq) AS before FROM station_log)
    WHERE before IS DISTINCT FROM o_orderpriority"""


@query("c5_scd2_apply", """
    SELECT station_uid, o_orderpriority, valid_from,
           CASE WHEN valid_to IS NULL AND (n.uid IS NULL OR n.priority IS DISTINCT FROM o_orderpriority)
                THEN TIMESTAMP '2001-08-02' ELSE valid_to END AS valid_to
    FROM versions LEFT JOIN snap n ON n.uid = station_uid
    UNION ALL
    SELECT n.uid, n.priority, TIMESTAMP '2001-08-02', NULL
    FROM snap n LEFT JOIN versions v ON v.station_uid = n.uid AND v.valid_to IS NULL
    WHERE v.station_uid IS NULL OR v.o_orderpriority IS DISTINCT FROM n.priority""", versions=SCD2_LOG, snap="""
    SELECT CAST(c_custkey AS VARCHAR) AS uid,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '1-URGENT' ELSE '5-LOW' END AS priority
    FROM customer WHERE c_acctbal > 0""")
def c5(spark, sf):
    """History from the log, then one snapshot in which keys change, stay, vanish and appear."""
    history = scd2_from_log(v.station_log(spark, sf), "station_uid", "seen_at", ["o_orderpriority"], ["seq"])
    urgent = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    current = v.table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("station_uid"),
        F.when(urgent, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"))
    return scd2_apply(history, current, "station_uid", ["o_orderpriority"], v.ORDERS_AS_OF)


@query("c5b_scd2_from_log", "SELECT * FROM versions", versions=SCD2_LOG)
def c5b(spark, sf):
    return scd2_from_log(v.station_log(spark, sf), "station_uid", "seen_at", ["o_orderpriority"], ["seq"])


@query("c6_dim_stations", """
    SELECT md5(station_uid || '|' || CAST(epoch_us(valid_from) AS VARCHAR)) AS station_sk, station_uid, capacity,
           valid_from, valid_to, valid_to IS NULL AS is_current FROM capacity_dim""")
def c6(spark, sf):
    return dim_stations(v.capacity_dim(spark, sf))


ASOF = """
    SELECT o.seq, o.station_uid, o.source_updated_at, d.capacity, d.valid_from
    FROM obs o JOIN capacity_dim d ON d.station_uid = o.station_uid AND o.source_updated_at >= d.valid_from
     AND (d.valid_to IS NULL OR o.source_updated_at < d.valid_to)"""


@query("c7_asof_join", ASOF)
def c7(spark, sf):
    return asof_dim_join(v.obs(spark, sf), v.capacity_dim(spark, sf), "station_uid", "source_updated_at", ["capacity"]).select(
        "seq", "station_uid", "source_updated_at", "capacity", "valid_from")


@query("c7_asof_join_ordered", ASOF)
def c7_ordered(spark, sf):
    """The form for large dimensions."""
    return asof_dim_join(v.obs(spark, sf), v.capacity_dim(spark, sf), "station_uid", "source_updated_at", ["capacity"],
                         method="ordered").select("seq", "station_uid", "source_updated_at", "capacity", "valid_from")


@query("c7_asof_join_lineitem", """
    SELECT v.o_orderpriority, count(*) AS n, CAST(sum(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN versions v ON v.station_uid = CAST(o.o_custkey AS VARCHAR) AND l.l_shipdate >= v.valid_from
     AND (v.valid_to IS NULL OR l.l_shipdate < v.valid_to)
    GROUP BY 1""", versions=SCD2_LOG)
def c7_lineitem(spark, sf):
    """Lines by the priority their customer had at ship time."""
    owner = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("station_uid"))
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity").join(owner, "l_orderkey")
    dim = scd2_from_log(v.station_log(spark, sf), "station_uid", "seen_at", ["o_orderpriority"], ["seq"])
    return asof_dim_join(lines, dim, "station_uid", "l_shipdate", ["o_orderpriority"]).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


# The version that started last decides (of equal starts the one that ends last, then the greatest priority), if still valid.
OVERLAPS = """
    SELECT l_orderkey, l_linenumber, valid_from, o_orderpriority FROM (
      SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, d.*, row_number() OVER (
        PARTITION BY l.line ORDER BY d.valid_from DESC, d.valid_to DESC NULLS FIRST, d.o_orderpriority DESC) AS r
      FROM (SELECT *, row_number() OVER () AS line FROM lineitem) l JOIN orders o ON o.o_orderkey = l.l_orderkey
      JOIN spans d ON d.station_uid = CAST(o.o_custkey AS VARCHAR) AND l.l_shipdate >= d.valid_from
       AND (d.valid_to IS NULL OR d.valid_to > d.valid_from))
    WHERE r = 1 AND (valid_to IS NULL OR l_shipdate < valid_to)"""

SPANS = """
    SELECT CAST(o_custkey AS VARCHAR) AS station_uid, o_orderdate AS valid_from, o_orderpriority,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS valid_to FROM orders"""


def _overlapping(spark, sf, method):
    orders = v.table(spark, sf, "orders")
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("station_uid"))
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(owner, "l_orderkey")
    dim = orders.select(
        F.col("o_custkey").cast("string").alias("station_uid"), F.col("o_orderdate").alias("valid_from"), "o_orderpriority",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 400).cast("int"))).alias("valid_to"))
    return asof_dim_join(lines, dim, "station_uid", "l_shipdate", ["o_orderpriority"], method=method).select(
        "l_orderkey", "l_linenumber", "valid_from", "o_orderpriority")


@query("c7_asof_overlaps_pairs", OVERLAPS, spans=SPANS)
def c7_overlaps_pairs(spark, sf):
    """Versions that overlap, close early or start together: one meaning, here by pairing."""
    return _overlapping(spark, sf, "pairs")


@query("c7_asof_overlaps_ordered", OVERLAPS, spans=SPANS)
def c7_overlaps_ordered(spark, sf):
    """The same by the ordered pass."""
    return _overlapping(spark, sf, "ordered")


HOURLY = f"""
    SELECT h.*, s.station_name, s.capacity, s.lat, s.lng, CAST(hour_local AS DATE) AS local_date
    FROM (SELECT station_uid, CAST(date_trunc('hour', source_updated_at + INTERVAL 8 HOUR) AS TIMESTAMP) AS hour_local,
                 count(*) AS observations, {sql_round('avg(bikes_available)', 2)} AS avg_bikes_available,
                 min(bikes_available) AS min_bikes_available, {sql_round('avg(docks_available)', 2)} AS avg_docks_available,
                 {sql_round('count(*) FILTER (WHERE bikes_available = 0) / count(*)', 4)} AS empty_ratio,
                 {sql_round('count(*) FILTER (WHERE docks_available = 0) / count(*)', 4)} AS full_ratio
          FROM fact WHERE is_in_service {{where}} GROUP BY 1, 2) h
    LEFT JOIN stations s ON s.station_uid = h.station_uid"""


@query("c8_station_hourly", HOURLY.format(where=""))
def c8(spark, sf):
    return station_hourly(v.fact(spark, sf), v.stations(spark, sf), TZ)


@query("c8_station_hourly_of_versions", HOURLY.format(where=""))
def c8_versions(spark, sf):
    """Stations with an older version each, which must not double the hours."""
    now = v.stations(spark, sf).withColumn("is_current", F.lit(True))
    old = now.withColumns({"is_current": F.lit(False), "station_name": F.lit("before")})
    return station_hourly(v.fact(spark, sf), now.unionByName(old), TZ)


@query("c9_station_hourly_lookback", HOURLY.format(where="AND source_updated_at >= TIMESTAMP '2024-01-24 05:00:00'"))
def c9(spark, sf):
    """Recompute of whole hours only: the look-back start moves down to the full hour."""
    start = hour_aligned(datetime(2024, 1, 31, 5, 40), timedelta(days=7))
    return station_hourly(v.fact(spark, sf), v.stations(spark, sf), TZ, since=start)


@query("c10_published_order", "SELECT station_uid, station_name, bikes_available FROM snapshot_rows ORDER BY station_uid")
def c10(spark, sf):
    return v.snapshot_rows(spark, sf).select("station_uid", "station_name", "bikes_available").orderBy("station_uid")


@query("d1_bucket", f"SELECT event_id, {v.sql_bucket('ts', 1800)} AS half_hour, {v.sql_bucket('ts', v.BUCKET)} AS six_hours FROM events")
def d1(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", bucket(F.col("ts"), 1800).alias("half_hour"), bucket(F.col("ts"), v.BUCKET).alias("six_hours"))
