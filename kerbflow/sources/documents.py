"""Published snapshot documents and replies of the route service."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.functions.geo import point_key
from kerbflow.schemas import SNAPSHOT
from kerbflow.session import discard, store


class EmptyResultError(ValueError):
    """A result that must not replace the published one, because it has no rows."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The DataFrame itself, or an error when it is empty. Reads one row at most."""
    if df.isEmpty():
        raise EmptyResultError(message)
    return df


def snapshot_lines(payload: DataFrame, generated_at: Column) -> DataFrame:
    """The document as ordered lines: a head, one compact line per station by id, and a tail.

    Joined in order they are one JSON document. Lines are sorted by range, so no task and no cell holds all of it.
    """
    spark = payload.sparkSession
    last = payload.agg(F.max("id")).scalar()
    station = F.to_json(F.struct(*payload.columns))
    body = payload.select(
        F.lit(1).alias("part"), "id", F.concat(station, F.when(F.col("id") == last, "").otherwise(",")).alias("value"))
    head = F.concat(F.lit('{"generated_at":"'), generated_at, F.lit('","stations":['))
    ends = spark.range(2).select(
        F.when(F.col("id") == 0, 0).otherwise(2).alias("part"), F.lit("").alias("id"),
        F.when(F.col("id") == 0, head).otherwise(F.lit("]}")).alias("value"))
    return ends.unionByName(body).orderBy("part", "id").select("value")


def _versions(spark: SparkSession, path: str) -> tuple[list[str], object]:
    """Finished versions of a document, oldest first, and the file system they are on."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return [], fs
    found = [str(x.getPath()) for x in fs.listStatus(root) if x.getPath().getName().startswith("version=")]
    return sorted(p for p in found if fs.exists(context._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS"))), fs


def write_snapshot(payload: DataFrame, generated_at: Column, path: str, keep: int = 2) -> None:
    """Publish a new version of the document: text files that form it in the order of their names.

    A version counts once its mark of success is there, so readers see the old document or the new one, never a part.
    The newest `keep` versions stay for readers that are under way. An empty payload leaves everything as it is.
    """
    spark = payload.sparkSession
    fixed = store(payload, "payload")
    if fixed.isEmpty():
        discard(fixed)
        raise EmptyResultError("no station has a recent status")
    snapshot_lines(fixed, generated_at).write.text(f"{path}/version={time.time_ns():020}")
    discard(fixed)
    versions, fs = _versions(spark, path)
    for old in versions[:-keep]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old), True)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Station rows of the newest version of a document written by `write_snapshot`."""
    versions, _ = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no document at {path}")
    lines = spark.read.text(versions[-1])
    head = lines.where(F.col("value").startswith('{"generated_at"'))
    generated = head.agg(F.max(F.get_json_object(F.concat("value", F.lit("]}")), "$.generated_at"))).scalar()
    one = SNAPSHOT["stations"].dataType.elementType
    rows = lines.where(F.col("value").startswith('{"id"')).select(
        F.to_timestamp(generated).alias("generated_at"),
        F.from_json(F.regexp_replace("value", ",$", ""), one).alias("s"))
    return _station_rows(rows)


def parse_snapshot(documents: DataFrame, column: str = "value") -> DataFrame:
    """Station rows of whole documents, one per row."""
    doc = documents.select(F.from_json(column, SNAPSHOT).alias("d")).select(
        F.to_timestamp("d.generated_at").alias("generated_at"), F.explode("d.stations").alias("s"))
    return _station_rows(doc)


def _station_rows(doc: DataFrame) -> DataFrame:
    return doc.select(
        "generated_at", F.col("s.id").alias("station_uid"), F.col("s.name").alias("station_name"), "s.lat", "s.lng",
        F.col("s.bikes").alias("bikes_available"), F.col("s.docks").alias("docks_available"),
        F.col("s.in_service").alias("is_in_service"), F.to_timestamp("s.forecast.at").alias("forecast_for"),
        F.col("s.forecast.bikes").alias("predicted_bikes_available"))


ROUTE_REPLY = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("routes", T.ArrayType(T.StructType([
        T.StructField("duration", T.DoubleType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("geometry", T.StructType([
            T.StructField("coordinates", T.ArrayType(T.ArrayType(T.DoubleType())))])),
    ]))),
])


def parse_routes(replies: DataFrame) -> DataFrame:
    """Legs from route replies: minutes, metres, and the path as (lat, lng). Failed replies are left out.

    `replies` holds profile, from_lat, from_lng, to_lat, to_lng and the reply body.
    """
    parsed = replies.withColumn("r", F.from_json("body", ROUTE_REPLY)).where(
        (F.col("r.code") == "Ok") & (F.size("r.routes") > 0)).withColumn("route", F.col("r.routes")[0])
    path = F.transform("route.geometry.coordinates", lambda p: F.array(p[1], p[0]))
    return parsed.select(
        "profile", point_key(F.col("from_lat"), F.col("from_lng")).alias("from_key"),
        point_key(F.col("to_lat"), F.col("to_lng")).alias("to_key"),
        (F.col("route.duration") / 60).alias("minutes"), F.col("route.distance").alias("meters"), path.alias("path"))
