"""Distances, travel times and the cubes that index points on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbflow.functions.convert import round_to

# Fixed values of the travel model.
EARTH_RADIUS_M = 6_371_000.0
DETOUR_FACTOR = 1.3
WALK_M_PER_MIN = 75.0
RIDE_M_PER_MIN = 250.0


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def distance_mm(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance to the millimetre. Ranking uses it so that equally far stations tie and fall back to the id."""
    return round_to(haversine(lat1, lng1, lat2, lng2), 3)


def walk_minutes(meters: Column) -> Column:
    return meters * F.lit(DETOUR_FACTOR) / F.lit(WALK_M_PER_MIN)


def ride_minutes(meters: Column) -> Column:
    return meters * F.lit(DETOUR_FACTOR) / F.lit(RIDE_M_PER_MIN)


def ride_meters(meters: Column) -> Column:
    return meters * F.lit(DETOUR_FACTOR)


def cartesian(lat: Column, lng: Column) -> tuple[Column, Column, Column]:
    """Position in metres from the centre of the earth.

    Straight-line distance here is never longer than the great circle and orders points the same way, and it
    has no seams at the poles or the date line, so cubes of it are a safe index for nearest neighbours.
    """
    lat_r, lng_r = F.radians(lat), F.radians(lng)
    r = F.lit(EARTH_RADIUS_M)
    return r * F.cos(lat_r) * F.cos(lng_r), r * F.cos(lat_r) * F.sin(lng_r), r * F.sin(lat_r)


def point_key(lat: Column, lng: Column) -> Column:
    """Coordinates to five decimals as one whole number, for exact matching of known legs."""
    lat5, lng5 = [F.floor(c * F.lit(100000.0) + F.lit(0.5)).cast("long") for c in (lat, lng)]
    return lat5 * F.lit(100_000_000) + lng5
