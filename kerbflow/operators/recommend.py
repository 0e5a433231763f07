"""Rent and return station pairs for trips, ranked by time and risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.convert import round_to
from kerbflow.functions.geo import (
    DETOUR_FACTOR, distance_mm, haversine, point_key, ride_meters, ride_minutes, walk_minutes,
)
from kerbflow.functions.status import LOW_THRESHOLD
from kerbflow.functions.timefns import micros
from kerbflow.operators.dedupe import top_per_key
from kerbflow.operators.knn import knn, knn_columns
from kerbflow.session import store

# Fixed values of the ranking.
CANDIDATES = 6
RISK_PENALTY_MIN = 4.0
OPTIONS = 3
NAMED_WITHIN_M = 60.0
OUT_OF_AREA_M = 3000.0
WALK_SLACK_MIN = 2.0

ENDS = ["origin_lat", "origin_lng", "dest_lat", "dest_lng"]
STATION_FIELDS = ["station_uid", "lat", "lng", "bikes_available", "docks_available", "forecast_for",
                  "predicted_bikes_available"]


def horizon_minutes(forecast_for: Column, snapshot_time: Column) -> Column:
    return (micros(forecast_for) - micros(snapshot_time)) / F.lit(60_000_000.0)


def estimate_bikes(bikes: Column, docks: Column, forecast_for: Column, forecast_bikes: Column, minutes: Column,
                   snapshot_time: Column) -> tuple[Column, Column]:
    """(bikes expected some minutes after the snapshot, whether a forecast moved the number).

    Linear between now and the forecast, flat after it, clipped to the docks; an expired forecast is ignored.
    """
    horizon = horizon_minutes(forecast_for, snapshot_time)
    usable = horizon.isNotNull() & forecast_bikes.isNotNull() & (horizon > 0)
    progress = F.least(F.greatest(F.try_divide(minutes, horizon), F.lit(0.0)), F.lit(1.0))
    moved = bikes + (forecast_bikes - bikes) * progress
    capacity = (bikes + docks).cast("double")
    value = F.when(usable, F.least(F.greatest(moved, F.lit(0.0)), capacity)).otherwise(bikes.cast("double"))
    return value, usable & (progress > 0)


def _legs_of(legs: DataFrame, profile: str, name: str) -> DataFrame:
    """Known legs of one profile, one row per direction, with prefixed columns."""
    return legs.where(F.col("profile") == profile).groupBy("from_key", "to_key").agg(
        F.min(F.struct("minutes", "meters")).alias(name)
    ).select(F.col("from_key").alias(f"{name}_from"), F.col("to_key").alias(f"{name}_to"),
             F.col(f"{name}.minutes").alias(f"{name}_minutes"), F.col(f"{name}.meters").alias(f"{name}_meters"))


def _attach(df: DataFrame, legs: DataFrame | None, profile: str, name: str, start: tuple[Column, Column],
            end: tuple[Column, Column], minutes: Column, meters: Column | None = None) -> DataFrame:
    """Travel time of one leg: the known one where there is one, else the straight-line estimate.

    Popular legs are hot keys of this join. The legs side has one row per key, so Spark may broadcast it when it is
    small and split the large side when it is skewed.
    """
    if legs is None:
        out = df.withColumn(name, minutes).withColumn(f"{name}_known", F.lit(False))
        return out if meters is None else out.withColumn(f"{name}_meters", meters)
    known = _legs_of(legs, profile, "leg")
    out = df.withColumn("leg_from", point_key(*start)).withColumn("leg_to", point_key(*end)).join(
        known, ["leg_from", "leg_to"], "left")
    out = out.withColumn(name, F.coalesce("leg_minutes", minutes)).withColumn(
        f"{name}_known", F.col("leg_minutes").isNotNull())
    if meters is not None:
        out = out.withColumn(f"{name}_meters", F.coalesce("leg_meters", meters))
    return out.drop("leg_from", "leg_to", "leg_minutes", *([] if meters is None and name == "leg" else []),
                    *([] if name == "leg" else ["leg_meters"]))


def _side(df: DataFrame, neighbours: str, stations: DataFrame, prefix: str) -> DataFrame:
    """One row per trip and candidate station of one side, with the station's columns prefixed."""
    # The outer form keeps Spark from testing the array first, which would rank the candidates twice.
    spread = df.select(*[c for c in df.columns if c != neighbours], F.posexplode_outer(neighbours).alias("__pos", "__s"))
    rows = spread.select(
        *[c for c in df.columns if c != neighbours], (F.col("__pos") + 1).alias(f"{prefix}_rank"),
        F.col("__s.station_uid").alias(f"{prefix}_uid"), F.col("__s.meters").alias(f"{prefix}_m"))
    named = stations.select(*[F.col(c).alias(f"{prefix}_{c}" if c != "station_uid" else f"{prefix}_uid")
                              for c in STATION_FIELDS])
    return rows.join(named, f"{prefix}_uid")


def trip_candidates(trips: DataFrame, stations: DataFrame, k: int = CANDIDATES, side: float | None = None) -> DataFrame:
    """Trips with the arrays of nearest in-service stations of origin and destination."""
    open_stations = stations.where(F.col("is_in_service"))
    return knn_columns(trips, open_stations, k, {
        "rent_near": ("origin_lat", "origin_lng"), "return_near": ("dest_lat", "dest_lng")}, side)


def _attach_return(rows: DataFrame, legs: DataFrame | None) -> DataFrame:
    """The walk from the return station to the destination."""
    return _attach(
        rows, legs, "walk", "walk_from_return", (F.col("return_lat"), F.col("return_lng")),
        (F.col("dest_lat"), F.col("dest_lng")),
        walk_minutes(haversine(F.col("return_lat"), F.col("return_lng"), F.col("dest_lat"), F.col("dest_lng"))))


def _journeys(trips: DataFrame) -> DataFrame:
    """Each pair of end points that trips have, once, under a `trip_id` of its own; the numbers are stored, so they stay."""
    return store(trips.select(*ENDS).dropna().distinct().withColumn("trip_id", F.monotonically_increasing_id()), "journeys")


def _for_trips(trips: DataFrame, found: DataFrame) -> DataFrame:
    """Rows found for journeys, for each trip between their end points; without all coordinates a trip has no pairs."""
    return trips.join(found.drop("trip_id"), ENDS).select(*trips.columns, *[c for c in found.columns if c not in (*ENDS, "trip_id")])


def trip_pairs(trips: DataFrame, stations: DataFrame, snapshot_time: Column, legs: DataFrame | None = None,
               k: int = CANDIDATES, side: float | None = None) -> DataFrame:
    """All feasible rent/return pairs of each trip (at most k x k) with times, expected bikes and docks, and score.

    They depend on the end points alone, so they are found once for all trips between the same two.
    """
    return _for_trips(trips, store(_journey_pairs(_journeys(trips), stations, snapshot_time, legs, k, side), "journey-pairs"))


def _journey_pairs(trips: DataFrame, stations: DataFrame, snapshot_time: Column, legs: DataFrame | None,
                   k: int, side: float | None) -> DataFrame:
    """The pairs of `trip_pairs` for trips of which each has a `trip_id` of its own."""
    base = trip_candidates(trips, stations, k, side)
    if legs is not None:
        base = store(base, "trip-candidates")  # read for either side
    rent = _side(base, "rent_near", stations, "rent")
    rent = _attach(
        rent, legs, "walk", "walk_to_rent", (F.col("origin_lat"), F.col("origin_lng")),
        (F.col("rent_lat"), F.col("rent_lng")),
        walk_minutes(haversine(F.col("origin_lat"), F.col("origin_lng"), F.col("rent_lat"), F.col("rent_lng"))))
    bikes, _ = estimate_bikes(
        F.col("rent_bikes_available"), F.col("rent_docks_available"), F.col("rent_forecast_for"),
        F.col("rent_predicted_bikes_available"), F.col("walk_to_rent"), snapshot_time)
    # Pick-up is decided before returns are spread, so empty stations cost no pairs.
    rent = rent.withColumn("bikes_at_pickup", bikes).where(F.floor("bikes_at_pickup") >= 1)

    if legs is None:
        both = _attach_return(_side(rent, "return_near", stations, "return"), None)
    else:
        # The walk from a return station belongs to the trip and the station: it is looked up once, not once a pair.
        returns = _attach_return(_side(base.drop("rent_near"), "return_near", stations, "return"), legs)
        own = [c for c in returns.columns if c not in base.columns]
        same = F.col("a.trip_id").eqNullSafe(F.col("b.trip_id"))
        both = rent.drop("return_near").alias("a").join(returns.select("trip_id", *own).alias("b"), same).select("a.*", *[f"b.{c}" for c in own])
    both = both.where(F.col("return_uid") != F.col("rent_uid"))
    apart = haversine(F.col("rent_lat"), F.col("rent_lng"), F.col("return_lat"), F.col("return_lng"))
    both = _attach(both, legs, "ride", "ride", (F.col("rent_lat"), F.col("rent_lng")),
                   (F.col("return_lat"), F.col("return_lng")), ride_minutes(apart), ride_meters(apart))
    arriving, forecasted = estimate_bikes(
        F.col("return_bikes_available"), F.col("return_docks_available"), F.col("return_forecast_for"),
        F.col("return_predicted_bikes_available"), F.col("walk_to_rent") + F.col("ride"), snapshot_time)
    docks = (F.col("return_bikes_available") + F.col("return_docks_available")).cast("double") - arriving
    both = both.withColumn("docks_at_arrival", docks).withColumn("docks_forecasted", forecasted).where(
        F.floor("docks_at_arrival") >= 1)
    few_bikes, few_docks = F.col("bikes_at_pickup") < LOW_THRESHOLD, F.col("docks_at_arrival") < LOW_THRESHOLD
    total = F.col("walk_to_rent") + F.col("ride") + F.col("walk_from_return")
    return both.withColumn("few_bikes", few_bikes).withColumn("few_docks", few_docks).withColumn(
        "total_minutes", total
    ).withColumn("score", F.col("total_minutes") + F.lit(RISK_PENALTY_MIN) * (
        F.col("few_bikes").cast("int") + F.col("few_docks").cast("int")))


def recommend(trips: DataFrame, stations: DataFrame, snapshot_time: Column, legs: DataFrame | None = None,
              options: int = OPTIONS, k: int = CANDIDATES, side: float | None = None) -> DataFrame:
    """Best pairs of each trip; equal scores keep the nearer rent station, then the nearer return station.

    The best pairs of each journey are stored, and trips meet these few; a repeated trip_id is ranked as one trip.
    """
    order = [round_to(F.col("score"), 3).asc(), F.col("rent_rank").asc(), F.col("return_rank").asc()]
    pairs = _journey_pairs(_journeys(trips), stations, snapshot_time, legs, k, side)
    best = store(top_per_key(pairs, ["trip_id"], order, options), "journey-options")
    return top_per_key(_for_trips(trips, best), ["trip_id"], order, options, rank="option_rank")


def option_legs(options: DataFrame) -> DataFrame:
    """The three legs of each option, ride first: its time matters most."""
    def leg(priority: int, name: str, profile: str, a: tuple[str, str], b: tuple[str, str]) -> Column:
        return F.struct(
            F.lit(priority).alias("priority"), F.lit(name).alias("leg"), F.lit(profile).alias("profile"),
            point_key(F.col(a[0]), F.col(a[1])).alias("from_key"), point_key(F.col(b[0]), F.col(b[1])).alias("to_key"),
            F.col(f"{name}_known").alias("known"))
    rent, ret = ("rent_lat", "rent_lng"), ("return_lat", "return_lng")
    legs = F.array(
        leg(0, "ride", "ride", rent, ret),
        leg(1, "walk_to_rent", "walk", ("origin_lat", "origin_lng"), rent),
        leg(2, "walk_from_return", "walk", ret, ("dest_lat", "dest_lng")))
    return options.select("trip_id", "option_rank", F.explode(legs).alias("l")).select(
        "trip_id", "option_rank", "l.*")


def missing_legs(options: DataFrame, cap: int | None = None) -> DataFrame:
    """Legs still to be looked up for the options of a trip, in order of need, each once; with `cap`, the first ones."""
    unknown = option_legs(options).where(~F.col("known"))
    once = top_per_key(unknown, ["trip_id", "profile", "from_key", "to_key"],
                       [F.col("option_rank").asc(), F.col("priority").asc()])
    return top_per_key(once, ["trip_id"], [F.col("option_rank").asc(), F.col("priority").asc()], cap, rank="request")


def leg_status(options: DataFrame) -> DataFrame:
    """Per trip: exact when all legs of all options are known, else partial."""
    every = F.bool_and(F.col("ride_known") & F.col("walk_to_rent_known") & F.col("walk_from_return_known"))
    return options.groupBy("trip_id").agg(F.when(every, "exact").otherwise("partial").alias("routing"))


def walk_only(trips: DataFrame, options: DataFrame, slack: float = WALK_SLACK_MIN) -> DataFrame:
    """Walking time of the whole trip, and whether it is about as fast as the best option."""
    direct = walk_minutes(haversine(F.col("origin_lat"), F.col("origin_lng"), F.col("dest_lat"), F.col("dest_lng")))
    best = options.where(F.col("option_rank") == 1).select("trip_id", F.col("total_minutes").alias("best_minutes"))
    return trips.select("trip_id", direct.alias("walk_only_minutes")).join(best, "trip_id", "left").withColumn(
        "walking_is_as_fast", F.coalesce(F.col("walk_only_minutes") <= F.col("best_minutes") + F.lit(slack), F.lit(False)))


def describe_points(points: DataFrame, stations: DataFrame, side: float | None = None) -> DataFrame:
    """Points labelled by their nearest station, with the out-of-area flag."""
    near = knn(points, stations, 1, out="__near", side=side).withColumn("__s", F.element_at("__near", 1))
    named = near.select(*points.columns, F.col("__s.station_uid").alias("station_uid"), F.col("__s.meters").alias("meters"))
    joined = named.join(stations.select("station_uid", "station_name"), "station_uid", "left")
    return joined.select(
        *points.columns, "station_uid", "meters",
        F.when(F.col("meters") < NAMED_WITHIN_M, F.col("station_name"))
        .otherwise(F.concat(F.lit("near "), F.col("station_name"))).alias("label"),
        (F.col("meters") > OUT_OF_AREA_M).alias("out_of_area"))


def service_area(stations: DataFrame, pad: float = 0.08) -> DataFrame:
    """Bounding box of all stations, padded on each side by a share of its size."""
    box = stations.agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lng").alias("w"), F.max("lng").alias("e"))
    dlat, dlng = (F.col("n") - F.col("s")) * F.lit(pad), (F.col("e") - F.col("w")) * F.lit(pad)
    return box.select((F.col("s") - dlat).alias("south"), (F.col("n") + dlat).alias("north"),
                      (F.col("w") - dlng).alias("west"), (F.col("e") + dlng).alias("east"))
