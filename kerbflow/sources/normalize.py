"""Raw nested records to flat typed rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.functions.convert import display_name, to_double, to_int, to_utc
from kerbflow.functions.status import in_service
from kerbflow.schemas import DOUBLE_COLUMNS, INT_COLUMNS, TIME_COLUMNS, raw_schema


class SchemaError(ValueError):
    """A batch lacks a required field altogether."""


def assert_fields(raw: DataFrame, required: tuple[str, ...]) -> None:
    """Fail when a required field has no value in any record of the batch; an empty batch passes.

    The check is per batch: single rows may still lack a value. One aggregate over the needed leaves decides. Typed rows
    no longer tell a null field from an absent one; `assert_present` does, on the records themselves.
    """
    row = raw.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.bool_or(F.col(p).isNotNull()).alias(f"f{i}") for i, p in enumerate(required)]).first()
    missing = [p for i, p in enumerate(required) if row["rows"] and not row[f"f{i}"]]
    if missing:
        raise SchemaError(f"fields missing in every record: {missing}")


def read_records(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Raw responses as one VARIANT `record` a row, which still tells a null field from an absent one.

    Each file is one JSON array of records; with `lines`, each line of a file is.
    """
    responses = (spark.read.option("multiLine", not lines).option("recursiveFileLookup", True)
                 .option("singleVariantColumn", "response").json(path))
    return responses.lateralJoin(spark.tvf.variant_explode(F.col("response").outer())).select(F.col("value").alias("record"))


def field_presence(records: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(field, present, records): in how many records each field stands, be it with a null. One aggregate over the records."""
    found = records.agg(F.count(F.lit(1)).alias("records"), *[
        F.count_if(F.try_variant_get("record", f"$.{path}", "variant").isNotNull()).alias(f"f{i}") for i, path in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(path).alias("field"), F.col(f"f{i}").alias("present")) for i, path in enumerate(fields)])
    return found.select(F.explode(rows).alias("p"), "records").select("p.field", "p.present", "records")


def assert_present(records: DataFrame, required: tuple[str, ...]) -> None:
    """Fail when a required field stands in no record of the batch. A field that is null everywhere is there; an empty batch passes."""
    missing = [r["field"] for r in field_presence(records, required).where("present = 0 AND records > 0").collect()]
    if missing:
        raise SchemaError(f"fields missing in every record: {sorted(missing, key=required.index)}")


def typed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with the nested schema of `raw_schema`: leaves are text, also where a number came."""
    def leaf(path: str) -> Column:
        return F.try_variant_get("record", f"$.{path}", "string")

    return records.select(*[
        F.struct(*[leaf(f"{f.name}.{g.name}").alias(g.name) for g in f.dataType.fields]).alias(f.name)
        if isinstance(f.dataType, T.StructType) else leaf(f.name).alias(f.name) for f in schema.fields])


def normalize_records(records: DataFrame, fields: dict[str, str], city: str, ingested_at: datetime,
                      required: tuple[str, ...] = ()) -> DataFrame:
    """`normalize` for VARIANT records, with required fields judged by presence."""
    if required:
        assert_present(records, required)
    return normalize(typed_records(records, raw_schema(fields)), fields, city, ingested_at)


def normalize(raw: DataFrame, fields: dict[str, str], city: str, ingested_at: datetime | None = None,
              required: tuple[str, ...] = ()) -> DataFrame:
    """Mapped fields, renamed and typed, in a fixed order, plus city and load time. Rows without a key are dropped.

    `raw` has the schema of `raw_schema(fields)`; without `ingested_at` it brings that column itself.
    """
    if required:
        assert_fields(raw, required)

    def typed(path: str, name: str):
        col = F.col(path)
        if name in INT_COLUMNS:
            return to_int(col).alias(name)
        if name in DOUBLE_COLUMNS:
            return to_double(col).alias(name)
        return (to_utc(col) if name in TIME_COLUMNS else col).alias(name)

    loaded = F.col("ingested_at") if ingested_at is None else F.lit(
        ingested_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    flat = raw.select(*[typed(p, n) for p, n in fields.items()], F.lit(city).alias("city"), loaded.alias("ingested_at"))
    return flat.where(F.col("station_uid").isNotNull())


def stage_observations(raw: DataFrame) -> DataFrame:
    """Typed observations with key and time, and the in-service flag."""
    return raw.where(F.col("station_uid").isNotNull() & F.col("source_updated_at").isNotNull()).withColumn(
        "is_in_service", in_service(F.col("service_status")))


def station_rows(df: DataFrame, prefix: str) -> DataFrame:
    """Reference rows for the stations table: display name and plain types, rows without a key dropped."""
    return df.where(F.col("station_uid").isNotNull() & (F.col("station_uid") != "")).select(
        "station_uid", display_name(F.col("station_name"), prefix).alias("station_name"),
        F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"),
        F.col("capacity").cast("int").alias("capacity"))
