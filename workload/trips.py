"""Snapshot, nearest stations, trip ranking, legs and text search (F)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from kerbflow.functions.geo import haversine, ride_meters, ride_minutes, walk_minutes
from kerbflow.functions.convert import round_to
from kerbflow.functions.status import availability_level
from kerbflow.functions.timefns import is_stale
from kerbflow.operators import recommend as rec
from kerbflow.operators.knn import knn
from kerbflow.operators.search import clean_places, match_stations
from kerbflow.plans.serving import iso_utc, latest_availability, pending_forecast, snapshot, snapshot_payload
from kerbflow.session import scratch_dir, store
from kerbflow.sources.documents import parse_routes, read_snapshot, write_snapshot
from workload import views as v
from workload.registry import query
from workload.views import EVENTS_AS_OF, sql_haversine, sql_key, sql_round

PREFIX = "Customer#"

SNAP = ["station_uid", "station_name", "lat", "lng", "bikes_available", "docks_available", "is_in_service",
        "source_updated_at", "forecast_for", "predicted_bikes_available"]


def now():
    """The snapshot time."""
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def _near_sql(kind: str) -> str:
    """The k nearest in-service stations of each distinct point, by brute force."""
    meters = sql_round(sql_haversine("p.lat", "p.lng", "s.lat", "s.lng"), 3)
    return f"""
    SELECT p.lat AS p_lat, p.lng AS p_lng, s.station_uid, {meters} AS meters,
           row_number() OVER (PARTITION BY p.lat, p.lng ORDER BY {meters}, s.station_uid) AS r
    FROM (SELECT DISTINCT {kind}_lat AS lat, {kind}_lng AS lng FROM trips) p
    CROSS JOIN (SELECT * FROM snapshot_rows WHERE is_in_service) s
    QUALIFY r <= 6"""


def _estimate_sql(s: str, minutes: str) -> str:
    horizon = f"((epoch_us({s}.forecast_for) - epoch_us(TIMESTAMP '2024-01-31')) / 60000000.0::DOUBLE)"
    return f"""CASE WHEN {s}.forecast_for IS NOT NULL AND {s}.predicted_bikes_available IS NOT NULL AND {horizon} > 0
        THEN least(greatest({s}.bikes_available + ({s}.predicted_bikes_available - {s}.bikes_available)
             * least(greatest(({minutes}) / {horizon}, 0.0::DOUBLE), 1.0::DOUBLE), 0.0::DOUBLE),
             CAST({s}.bikes_available + {s}.docks_available AS DOUBLE))
        ELSE CAST({s}.bikes_available AS DOUBLE) END"""


def _pairs_sql(legs: bool) -> dict[str, str]:
    """Feasible pairs of every trip."""
    def leg(alias: str, profile: str, a: str, b: str) -> str:
        return (f"LEFT JOIN leg1 {alias} ON {alias}.profile = '{profile}' AND {alias}.from_key = {sql_key(*a.split())} "
                f"AND {alias}.to_key = {sql_key(*b.split())}") if legs else ""
    walk1 = f"({sql_haversine('t.origin_lat', 't.origin_lng', 'a.lat', 'a.lng')}) * 1.3::DOUBLE / 75.0::DOUBLE"
    ride = f"({sql_haversine('p.a_lat', 'p.a_lng', 'b.lat', 'b.lng')}) * 1.3::DOUBLE"
    walk2 = f"({sql_haversine('b.lat', 'b.lng', 'p.dest_lat', 'p.dest_lng')}) * 1.3::DOUBLE / 75.0::DOUBLE"
    known = (lambda alias, col, x: f"coalesce({alias}.{col}, {x})") if legs else (lambda alias, col, x: x)
    has = (lambda alias: f"{alias}.minutes IS NOT NULL") if legs else (lambda alias: "false")
    rents = f"""
    SELECT t.*, a.station_uid AS rent_uid, a.lat AS a_lat, a.lng AS a_lng, n.r AS rent_rank,
           {known('l1', 'minutes', walk1)} AS walk_to_rent, {has('l1')} AS walk1_known,
           {_estimate_sql('a', known('l1', 'minutes', walk1))} AS bikes_at_pickup
    FROM trips t JOIN near_origin n ON n.p_lat = t.origin_lat AND n.p_lng = t.origin_lng
    JOIN snapshot_rows a ON a.station_uid = n.station_uid
    {leg('l1', 'walk', 't.origin_lat t.origin_lng', 'a.lat a.lng')}"""
    rides = f"""
    SELECT p.*, b.station_uid AS return_uid, b.lat AS b_lat, b.lng AS b_lng, n.r AS return_rank,
           {known('l2', 'minutes', f'{ride} / 250.0::DOUBLE')} AS ride, {has('l2')} AS ride_known,
           {known('l2', 'meters', ride)} AS ride_meters, {known('l3', 'minutes', walk2)} AS walk_from_return,
           {has('l3')} AS walk2_known,
           CAST(b.bikes_available + b.docks_available AS DOUBLE) -
             ({_estimate_sql('b', f"p.walk_to_rent + {known('l2', 'minutes', f'{ride} / 250.0::DOUBLE')}")}) AS docks_at_arrival
    FROM rents p JOIN near_dest n ON n.p_lat = p.dest_lat AND n.p_lng = p.dest_lng
    JOIN snapshot_rows b ON b.station_uid = n.station_uid
    {leg('l2', 'ride', 'p.a_lat p.a_lng', 'b.lat b.lng')}
    {leg('l3', 'walk', 'b.lat b.lng', 'p.dest_lat p.dest_lng')}
    WHERE floor(p.bikes_at_pickup) >= 1 AND b.station_uid <> p.rent_uid"""
    pairs = """
    SELECT *, walk_to_rent + ride + walk_from_return AS total_minutes, bikes_at_pickup < 3 AS few_bikes,
           docks_at_arrival < 3 AS few_docks
    FROM rides WHERE floor(docks_at_arrival) >= 1"""
    options = f"""
    SELECT *, total_minutes + 4.0::DOUBLE * (CAST(few_bikes AS INTEGER) + CAST(few_docks AS INTEGER)) AS score,
           CAST(row_number() OVER (PARTITION BY trip_id ORDER BY
             {sql_round("total_minutes + 4.0::DOUBLE * (CAST(few_bikes AS INTEGER) + CAST(few_docks AS INTEGER))", 3)},
             rent_rank, return_rank) AS INTEGER) AS option_rank
    FROM pairs QUALIFY option_rank <= 3"""
    return {"near_origin": _near_sql("origin"), "near_dest": _near_sql("dest"), "rents": rents, "rides": rides,
            "pairs": pairs, "options": options, "leg1": """
    SELECT profile, from_key, to_key, unnest(min({'minutes': minutes, 'meters': meters})) FROM legs GROUP BY 1, 2, 3"""}


OPTION_SQL = f"""
    SELECT trip_id, option_rank, rent_uid, return_uid, {sql_round('walk_to_rent', 3)} AS walk_to_rent,
           {sql_round('ride', 3)} AS ride, {sql_round('ride_meters', 1)} AS ride_meters,
           {sql_round('walk_from_return', 3)} AS walk_from_return, {sql_round('total_minutes', 3)} AS total_minutes,
           {sql_round('bikes_at_pickup', 3)} AS bikes_at_pickup, {sql_round('docks_at_arrival', 3)} AS docks_at_arrival,
           few_bikes, few_docks, {sql_round('score', 3)} AS score FROM options"""


def _option_columns(options):
    r = [("walk_to_rent", 3), ("ride", 3), ("ride_meters", 1), ("walk_from_return", 3), ("total_minutes", 3),
         ("bikes_at_pickup", 3), ("docks_at_arrival", 3), ("score", 3)]
    return options.select("trip_id", "option_rank", "rent_uid", "return_uid", "few_bikes", "few_docks",
                          *[round_to(F.col(c), d).alias(c) for c, d in r])


def published(spark, sf):
    """The snapshot as a stored table, as trip ranking reads it."""
    return store(v.snapshot_rows(spark, sf), "snapshot")


def with_legs(spark, sf):
    return rec.recommend(v.trips(spark, sf), published(spark, sf), now(), v.legs(spark, sf))


def without_legs(spark, sf):
    return rec.recommend(v.trips(spark, sf), published(spark, sf), now())


@query("f1_latest_availability", "SELECT * FROM latest_obs")
def f1(spark, sf):
    return latest_availability(v.obs_raw(spark, sf), EVENTS_AS_OF, v.month())


@query("f2_pending_forecast", "SELECT * FROM pending")
def f2(spark, sf):
    return pending_forecast(v.trend_forecasts(spark, sf), EVENTS_AS_OF)


@query("f3_snapshot", "SELECT * FROM snapshot_rows")
def f3(spark, sf):
    return v.snapshot_rows(spark, sf)


@query("f3_snapshot_without_forecasts", """
    SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS forecast_for, CAST(NULL AS DOUBLE) AS predicted_bikes_available)
    FROM snapshot_rows""")
def f3_none(spark, sf):
    """Before the first training."""
    return snapshot(v.stations(spark, sf), latest_availability(v.obs_raw(spark, sf), EVENTS_AS_OF, v.month()))


PAYLOAD = f"""
    SELECT station_uid AS id, regexp_replace(station_name, '^Customer#', '') AS name, {sql_round('lat', 5)} AS lat,
           {sql_round('lng', 5)} AS lng, bikes_available AS bikes, docks_available AS docks, is_in_service AS in_service,
           strftime(forecast_for, '%Y-%m-%dT%H:%M:%SZ') AS forecast_at,
           {sql_round('predicted_bikes_available', 1)} AS forecast_bikes FROM snapshot_rows"""


@query("f4_snapshot_payload", PAYLOAD)
def f4(spark, sf):
    payload = snapshot_payload(v.snapshot_rows(spark, sf), PREFIX)
    return payload.select("id", "name", "lat", "lng", "bikes", "docks", "in_service",
                          F.col("forecast.at").alias("forecast_at"), F.col("forecast.bikes").alias("forecast_bikes"))


@query("f5_snapshot_written_and_read", f"""
    SELECT id AS station_uid, name AS station_name, lat, lng, bikes AS bikes_available, docks AS docks_available,
           in_service AS is_in_service, CAST(replace(replace(forecast_at, 'T', ' '), 'Z', '') AS TIMESTAMP) AS forecast_for,
           forecast_bikes AS predicted_bikes_available, TIMESTAMP '2024-01-31' AS generated_at
    FROM payload""", payload=PAYLOAD)
def f5(spark, sf):
    """The published document, read back."""
    path = scratch_dir(spark, "snapshot")
    write_snapshot(snapshot_payload(v.snapshot_rows(spark, sf), PREFIX), iso_utc(now()), path)
    return read_snapshot(spark, path)


@query("f6_trip_distances", f"""
    SELECT trip_id, {sql_round(sql_haversine('origin_lat', 'origin_lng', 'dest_lat', 'dest_lng'), 3)} AS meters,
           {sql_round('(' + sql_haversine('origin_lat', 'origin_lng', 'dest_lat', 'dest_lng') + ') * 1.3 / 75.0', 3)} AS walk,
           {sql_round('(' + sql_haversine('origin_lat', 'origin_lng', 'dest_lat', 'dest_lng') + ') * 1.3 / 250.0', 3)} AS ride,
           {sql_round('(' + sql_haversine('origin_lat', 'origin_lng', 'dest_lat', 'dest_lng') + ') * 1.3', 3)} AS ride_meters
    FROM trips""")
def f6(spark, sf):
    m = haversine(F.col("origin_lat"), F.col("origin_lng"), F.col("dest_lat"), F.col("dest_lng"))
    return v.trips(spark, sf).select(
        "trip_id", round_to(m, 3).alias("meters"), round_to(walk_minutes(m), 3).alias("walk"),
        round_to(ride_minutes(m), 3).alias("ride"), round_to(ride_meters(m), 3).alias("ride_meters"))


@query("f8_estimate_bikes", f"""
    SELECT s.station_uid, m.ahead, {sql_round(_estimate_sql('s', 'CAST(m.ahead AS DOUBLE)'), 6)} AS bikes
    FROM snapshot_rows s CROSS JOIN (VALUES (0), (90), (400), (2000)) AS m(ahead)""")
def f8(spark, sf):
    """Bikes expected 0 to 2000 minutes ahead."""
    rows = v.snapshot_rows(spark, sf).withColumn("ahead", F.explode(F.array(*[F.lit(m) for m in (0, 90, 400, 2000)])))
    bikes, _ = rec.estimate_bikes(F.col("bikes_available"), F.col("docks_available"), F.col("forecast_for"),
                                  F.col("predicted_bikes_available"), F.col("ahead").cast("double"), now())
    return rows.select("station_uid", "ahead", round_to(bikes, 6).alias("bikes"))


@query("f9_knn", """
    SELECT t.trip_id, CAST(n.r AS INTEGER) AS r, n.station_uid, n.meters
    FROM trips t JOIN near_origin n ON n.p_lat = t.origin_lat AND n.p_lng = t.origin_lng""", **_pairs_sql(False))
def f9(spark, sf):
    """Six nearest in-service stations of every trip origin."""
    stations = published(spark, sf).where("is_in_service")
    near = knn(v.trips(spark, sf).select("trip_id", "origin_lat", "origin_lng"), stations, 6, "origin_lat", "origin_lng")
    return near.select("trip_id", F.posexplode_outer("neighbours").alias("p", "s")).select(
        "trip_id", (F.col("p") + 1).alias("r"), "s.station_uid", "s.meters")


@query("f9_knn_all_stations", f"""
    SELECT t.trip_id, CAST(n.r AS INTEGER) AS r, n.station_uid, n.meters
    FROM trips t JOIN (
      SELECT p.lat, p.lng, s.station_uid, {sql_round(sql_haversine('p.lat', 'p.lng', 's.lat', 's.lng'), 3)} AS meters,
             row_number() OVER (PARTITION BY p.lat, p.lng ORDER BY
               {sql_round(sql_haversine('p.lat', 'p.lng', 's.lat', 's.lng'), 3)}, s.station_uid) AS r
      FROM (SELECT DISTINCT dest_lat AS lat, dest_lng AS lng FROM trips) p CROSS JOIN stations s QUALIFY r <= 6) n
    ON n.lat = t.dest_lat AND n.lng = t.dest_lng""")
def f9_all(spark, sf):
    """Over all stations, many of which share a spot, so that ties decide."""
    near = knn(v.trips(spark, sf).select("trip_id", "dest_lat", "dest_lng"), v.stations(spark, sf), 6, "dest_lat", "dest_lng")
    return near.select("trip_id", F.posexplode_outer("neighbours").alias("p", "s")).select(
        "trip_id", (F.col("p") + 1).alias("r"), "s.station_uid", "s.meters")


@query("f10_recommend", OPTION_SQL, **_pairs_sql(False))
def f10(spark, sf):
    return _option_columns(without_legs(spark, sf))


@query("f10_all_pairs", f"""
    SELECT count(*) AS pairs, count(DISTINCT trip_id) AS trips, count(*) FILTER (WHERE few_bikes) AS few_bikes,
           count(*) FILTER (WHERE few_docks) AS few_docks FROM pairs""", **_pairs_sql(False))
def f10_pairs(spark, sf):
    pairs = rec.trip_pairs(v.trips(spark, sf), published(spark, sf), now())
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("trip_id").alias("trips"),
                     F.count_if("few_bikes").alias("few_bikes"), F.count_if("few_docks").alias("few_docks"))


@query("f11_recommend_with_known_legs", OPTION_SQL, **_pairs_sql(True))
def f11(spark, sf):
    return _option_columns(with_legs(spark, sf))


MISSING = f"""
    SELECT trip_id, leg, profile, from_key, to_key, CAST(row_number() OVER (PARTITION BY trip_id ORDER BY option_rank, priority) AS INTEGER) AS request
    FROM (SELECT * FROM (
        SELECT trip_id, option_rank, 0 AS priority, 'ride' AS leg, 'ride' AS profile, {sql_key('a_lat', 'a_lng')} AS from_key,
               {sql_key('b_lat', 'b_lng')} AS to_key FROM options WHERE NOT ride_known
        UNION ALL SELECT trip_id, option_rank, 1, 'walk_to_rent', 'walk', {sql_key('origin_lat', 'origin_lng')},
               {sql_key('a_lat', 'a_lng')} FROM options WHERE NOT walk1_known
        UNION ALL SELECT trip_id, option_rank, 2, 'walk_from_return', 'walk', {sql_key('b_lat', 'b_lng')},
               {sql_key('dest_lat', 'dest_lng')} FROM options WHERE NOT walk2_known)
      QUALIFY row_number() OVER (PARTITION BY trip_id, profile, from_key, to_key ORDER BY option_rank, priority) = 1)
    QUALIFY request <= 12"""


@query("f12_missing_legs", MISSING, **_pairs_sql(True))
def f12(spark, sf):
    return rec.missing_legs(with_legs(spark, sf)).select("trip_id", "leg", "profile", "from_key", "to_key", "request")


@query("f13_leg_status", """
    SELECT trip_id, CASE WHEN bool_and(ride_known AND walk1_known AND walk2_known) THEN 'exact' ELSE 'partial' END AS routing
    FROM options GROUP BY 1""", **_pairs_sql(True))
def f13(spark, sf):
    return rec.leg_status(with_legs(spark, sf))


@query("f14_walk_only", f"""
    SELECT t.trip_id, {sql_round('(' + sql_haversine('t.origin_lat', 't.origin_lng', 't.dest_lat', 't.dest_lng') + ') * 1.3 / 75.0', 3)} AS walk_only_minutes,
           {sql_round('o.total_minutes', 3)} AS best_minutes,
           coalesce(({sql_haversine('t.origin_lat', 't.origin_lng', 't.dest_lat', 't.dest_lng')}) * 1.3::DOUBLE / 75.0::DOUBLE
             <= o.total_minutes + 2, false) AS walking_is_as_fast
    FROM trips t LEFT JOIN options o ON o.trip_id = t.trip_id AND o.option_rank = 1""", **_pairs_sql(False))
def f14(spark, sf):
    out = rec.walk_only(v.trips(spark, sf), without_legs(spark, sf))
    return out.select("trip_id", round_to(F.col("walk_only_minutes"), 3).alias("walk_only_minutes"),
                      round_to(F.col("best_minutes"), 3).alias("best_minutes"), "walking_is_as_fast")


@query("f15_describe_points", """
    SELECT t.trip_id, n.station_uid, n.meters,
           CASE WHEN n.meters < 60 THEN s.station_name ELSE 'near ' || s.station_name END AS label,
           n.meters > 3000 AS out_of_area
    FROM trips t JOIN near_origin n ON n.p_lat = t.origin_lat AND n.p_lng = t.origin_lng AND n.r = 1
    JOIN stations s ON s.station_uid = n.station_uid""", **_pairs_sql(False))
def f15(spark, sf):
    points = v.trips(spark, sf).select("trip_id", F.col("origin_lat").alias("lat"), F.col("origin_lng").alias("lng"))
    return rec.describe_points(points, published(spark, sf).where("is_in_service")).drop("lat", "lng")


def _level_sql(count: str) -> str:
    return f"CASE WHEN NOT is_in_service THEN 'closed' WHEN {count} = 0 THEN 'none' WHEN {count} < 3 THEN 'low' ELSE 'ok' END"


@query("f16_availability_level", f"""
    SELECT station_uid, {_level_sql('bikes_available')} AS bikes, {_level_sql('docks_available')} AS docks FROM snapshot_rows""")
def f16(spark, sf):
    return v.snapshot_rows(spark, sf).select(
        "station_uid", availability_level(F.col("is_in_service"), F.col("bikes_available")).alias("bikes"),
        availability_level(F.col("is_in_service"), F.col("docks_available")).alias("docks"))


@query("f17_service_area", """
    SELECT min(lat) - (max(lat) - min(lat)) * 0.08::DOUBLE AS south, max(lat) + (max(lat) - min(lat)) * 0.08::DOUBLE AS north,
           min(lng) - (max(lng) - min(lng)) * 0.08::DOUBLE AS west, max(lng) + (max(lng) - min(lng)) * 0.08::DOUBLE AS east
    FROM stations""")
def f17(spark, sf):
    return rec.service_area(v.stations(spark, sf))


@query("f18_is_stale", """
    SELECT station_uid, epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(source_updated_at)) > 3600000000 AS stale
    FROM obs GROUP BY 1""")
def f18(spark, sf):
    newest = v.obs(spark, sf).groupBy("station_uid").agg(F.max("source_updated_at").alias("at"))
    return newest.select("station_uid", is_stale(F.col("at"), now()).alias("stale"))


@query("f19_match_stations", """
    SELECT a.query_id, m.match_rank, m.station_uid, m.station_name, m.position
    FROM asked a JOIN (
      SELECT t.text, s.station_uid, s.station_name, CAST(instr(lower(s.station_name), t.text) AS INTEGER) AS position,
             CAST(row_number() OVER (PARTITION BY t.text ORDER BY instr(lower(s.station_name), t.text),
                  length(s.station_name), s.station_uid) AS INTEGER) AS match_rank
      FROM (SELECT DISTINCT text FROM asked WHERE text <> '') t
      JOIN names s ON instr(lower(s.station_name), t.text) > 0
      QUALIFY match_rank <= 5) m ON m.text = a.text""",
       names="SELECT CAST(p_partkey AS VARCHAR) AS station_uid, p_name AS station_name FROM part",
       asked="""
      SELECT p_partkey AS query_id, CASE WHEN p_size <= 25 THEN lower(split_part(p_name, ' ', 2))
                                         WHEN p_size <= 45 THEN substr(p_name, 1, 2) ELSE '' END AS text FROM part""")
def f19(spark, sf):
    """One search per part: the second word in capitals, the first two letters, or blanks."""
    part = v.table(spark, sf, "part")
    word = F.concat(F.lit("  "), F.upper(F.element_at(F.split("p_name", " "), 2)), F.lit(" "))
    text = F.when(F.col("p_size") <= 25, word).when(F.col("p_size") <= 45, F.substring("p_name", 1, 2)).otherwise("  ")
    asked = part.select(F.col("p_partkey").alias("query_id"), text.alias("query"))
    names = part.select(F.col("p_partkey").cast("string").alias("station_uid"), F.col("p_name").alias("station_name"))
    return match_stations(asked, names).drop("query")


@query("f20_clean_places", """
    SELECT c_custkey, c_name AS name, array_to_string(list_slice(list_filter(
             [c_mktsegment, c_name, 'Road ' || CAST(c_nationkey AS VARCHAR), 'City', 'More'],
             lambda p: p <> c_name), 1, 3), '・') AS detail FROM customer""")
def f20(spark, sf):
    """Labels with the name, a postcode, the country and one part too many."""
    customers = v.table(spark, sf, "customer")
    display = F.concat_ws(", ", "c_mktsegment", "c_name", F.concat(F.lit("Road "), F.col("c_nationkey")),
                          F.col("c_custkey").cast("string"), F.lit("Xland"), F.lit("City"), F.lit("More"))
    places = customers.select("c_custkey", F.col("c_name").alias("name"), display.alias("display_name"))
    return clean_places(places, "Xland", "unnamed").select("c_custkey", "name", "detail")


@query("f21_parse_routes", f"""
    SELECT 'ride' AS profile, {sql_key('origin_lat', 'origin_lng')} AS from_key, {sql_key('dest_lat', 'dest_lng')} AS to_key,
           o_totalprice / 60 AS minutes, CAST(o_orderkey AS DOUBLE) AS meters, origin_lat AS first_lat, dest_lng AS last_lng
    FROM trips JOIN orders ON o_orderkey = trip_id WHERE o_orderstatus <> 'P'""")
def f21(spark, sf):
    """Route replies as JSON text, a third of them errors."""
    orders = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("trip_id"), "o_totalprice", "o_orderstatus")
    t = v.trips(spark, sf).join(orders, "trip_id")
    path = F.array(F.array("origin_lng", "origin_lat"), F.array("dest_lng", "dest_lat"))
    route = F.struct(F.col("o_totalprice").alias("duration"), F.col("trip_id").cast("double").alias("distance"),
                     F.struct(path.alias("coordinates")).alias("geometry"))
    body = F.to_json(F.struct(F.when(F.col("o_orderstatus") == "P", "NoRoute").otherwise("Ok").alias("code"),
                              F.array(route).alias("routes")))
    replies = t.select(F.lit("ride").alias("profile"), F.col("origin_lat").alias("from_lat"), F.col("origin_lng").alias("from_lng"),
                       F.col("dest_lat").alias("to_lat"), F.col("dest_lng").alias("to_lng"), body.alias("body"))
    return parse_routes(replies).select("profile", "from_key", "to_key", "minutes", "meters",
                                        F.col("path")[0][0].alias("first_lat"), F.col("path")[1][1].alias("last_lng"))
