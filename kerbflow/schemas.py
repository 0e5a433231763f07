"""Schemas, field maps and constants of the feed."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw field path -> column, in output order.
AVAILABILITY_FIELDS = {
    "StationUID": "station_uid",
    "StationID": "station_id",
    "ServiceType": "service_type",
    "ServiceStatus": "service_status",
    "AvailableRentBikes": "bikes_available",
    "AvailableReturnBikes": "docks_available",
    "AvailableRentBikesDetail.GeneralBikes": "general_bikes_available",
    "AvailableRentBikesDetail.ElectricBikes": "ebikes_available",
    "SrcUpdateTime": "source_updated_at",
    "UpdateTime": "api_updated_at",
}
STATION_FIELDS = {
    "StationUID": "station_uid",
    "StationID": "station_id",
    "AuthorityID": "authority_id",
    "StationName.Zh_tw": "station_name",
    "StationName.En": "station_name_en",
    "StationAddress.Zh_tw": "address",
    "StationAddress.En": "address_en",
    "StationPosition.PositionLat": "lat",
    "StationPosition.PositionLon": "lng",
    "BikesCapacity": "capacity",
    "ServiceType": "service_type",
    "SrcUpdateTime": "source_updated_at",
    "UpdateTime": "api_updated_at",
}
# Fields without which a batch is refused, and the kinds of the columns.
AVAILABILITY_REQUIRED = ("StationUID", "AvailableRentBikes", "AvailableReturnBikes", "SrcUpdateTime")
STATION_REQUIRED = ("StationUID", "StationName.Zh_tw", "StationPosition.PositionLat", "StationPosition.PositionLon")
INT_COLUMNS = {
    "service_type", "service_status", "bikes_available", "docks_available",
    "general_bikes_available", "ebikes_available", "capacity",
}
DOUBLE_COLUMNS = {"lat", "lng"}
TIME_COLUMNS = {"source_updated_at", "api_updated_at", "ingested_at"}
STATION_CHECK_COLUMNS = ("station_name", "address", "lat", "lng", "capacity", "service_type")


def column_type(name: str) -> T.DataType:
    if name in INT_COLUMNS:
        return T.LongType()
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    return T.TimestampType() if name in TIME_COLUMNS else T.StringType()


def staged_schema(fields: dict[str, str]) -> T.StructType:
    """Flat schema of staged rows: mapped fields plus city and load time."""
    names = [*fields.values(), "city", "ingested_at"]
    return T.StructType([T.StructField(n, column_type(n), n not in ("station_uid", "ingested_at")) for n in names])


def raw_schema(fields: dict[str, str]) -> T.StructType:
    """Nested schema of raw records. Leaves are text: a number may arrive as text and must not fail the read."""
    root: dict[str, list[str]] = {}
    for path in fields:
        head, _, leaf = path.partition(".")
        root.setdefault(head, []).extend([leaf] if leaf else [])
    return T.StructType([
        T.StructField(head, T.StructType([T.StructField(leaf, T.StringType()) for leaf in leaves]) if leaves
                      else T.StringType())
        for head, leaves in root.items()
    ])


STAGED_AVAILABILITY = staged_schema(AVAILABILITY_FIELDS)
STAGED_STATION = staged_schema(STATION_FIELDS)
RAW_AVAILABILITY = raw_schema(AVAILABILITY_FIELDS)
RAW_STATION = raw_schema(STATION_FIELDS)

# One message of the availability stream, and below it the rows of the result tables and of the snapshot.
MESSAGE = T.StructType([
    T.StructField("station_uid", T.StringType()),
    T.StructField("service_status", T.IntegerType()),
    T.StructField("bikes_available", T.IntegerType()),
    T.StructField("docks_available", T.IntegerType()),
    T.StructField("source_updated_at", T.TimestampType()),
])
STATUS_EVENT = T.StructType([
    T.StructField("station_uid", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("previous_status", T.StringType()),
    T.StructField("changed_at", T.TimestampType()),
    T.StructField("previous_duration_seconds", T.LongType()),
    T.StructField("bikes_available", T.IntegerType()),
    T.StructField("docks_available", T.IntegerType()),
])
# Keyed state of the stream: times as epoch microseconds, free of any zone.
STATION_STATE = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("since_us", T.LongType()),
    T.StructField("last_seen_us", T.LongType()),
])
FORECAST = T.StructType([
    T.StructField("station_uid", T.StringType()),
    T.StructField("feature_ts", T.TimestampType()),
    T.StructField("forecast_for", T.TimestampType()),
    T.StructField("bikes_available_now", T.LongType()),
    T.StructField("total_docks", T.LongType()),
    T.StructField("predicted_bikes_available", T.DoubleType()),
    T.StructField("model_trained_at", T.TimestampType()),
    T.StructField("predicted_at", T.TimestampType()),
])
SNAPSHOT = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("stations", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("bikes", T.LongType()),
        T.StructField("docks", T.LongType()),
        T.StructField("in_service", T.BooleanType()),
        T.StructField("forecast", T.StructType([
            T.StructField("at", T.StringType()), T.StructField("bikes", T.DoubleType())])),
    ]))),
])
