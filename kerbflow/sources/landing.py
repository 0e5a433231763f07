"""Files of the landing zone: raw responses, staged rows and the append-only raw tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.functions.timefns import to_local

# Timestamps in staged files and stamps of loads, always UTC.
STAMP_FORMAT = "%Y%m%dT%H%M%SZ"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_raw(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Raw responses: each file is one JSON array of nested records."""
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(schema).json(path)


def read_staged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Staged rows: one JSON object per line. Directory columns of the layout (city, dt, hour, load) come along."""
    return spark.read.schema(schema).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX").json(path)


def to_ndjson(df: DataFrame) -> DataFrame:
    """One JSON line per row: microsecond UTC times, nulls written out, text unescaped."""
    return df.select(to_ndjson_column(df.columns).alias("value"))


# Directories of a load, below the dataset.
LAYOUT = ["city", "dt", "hour", "load"]


def with_layout(df: DataFrame, tz: str, at: str = "ingested_at", loaded_at: datetime | None = None) -> DataFrame:
    """Add the directory columns: local date and hour of each row's load time, and the UTC stamp of this write."""
    local = to_local(F.col(at), tz)
    stamp = (loaded_at or datetime.now(timezone.utc)).strftime(STAMP_FORMAT)
    return df.withColumns({"dt": F.date_format(local, "yyyy-MM-dd"), "hour": F.date_format(local, "HH"), "load": F.lit(stamp)})


def _write_text(lines: DataFrame, path: str) -> None:
    """Rebalancing gives most hours one file and splits an hour that is too heavy for one task."""
    lines.hint("rebalance", "city", "dt", "hour").write.mode("append").partitionBy(*LAYOUT).text(path)


def land(df: DataFrame, root: str, dataset: str, tz: str, loaded_at: datetime | None = None) -> None:
    """Write staged rows as `<root>/staged/<dataset>/city=/dt=/hour=/load=` NDJSON; one call is one load."""
    placed = with_layout(df, tz, loaded_at=loaded_at)
    _write_text(placed.select(to_ndjson_column(df.columns).alias("value"), *LAYOUT), f"{root}/staged/{dataset}")


def land_raw(responses: DataFrame, root: str, dataset: str, tz: str, loaded_at: datetime | None = None) -> None:
    """Keep responses (city, ingested_at, body) as they came under `<root>/raw/<dataset>`, laid out like staged rows."""
    placed = with_layout(responses, tz, loaded_at=loaded_at)
    _write_text(placed.select(F.col("body").alias("value"), *LAYOUT), f"{root}/raw/{dataset}")


def to_ndjson_column(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {
        "ignoreNullFields": "false", "timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT})


def recent_days(df: DataFrame, as_of: datetime, tz: str, days: int = 2) -> DataFrame:
    """Rows of the last local days. The filter is on the directory column, so older directories are not listed."""
    today = F.to_date(to_local(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"), tz))
    return df.where((F.col("dt").cast("date") > F.date_sub(today, days)) & (F.col("dt").cast("date") <= today))


def newest_batch(df: DataFrame) -> DataFrame:
    """Rows of the newest load, by its UTC stamp and not by its local directory; nothing gives nothing.

    The stamp is a directory name, so finding it lists directories and reading it opens no other load.
    """
    newest = df.agg(F.max("load")).first()[0]
    return df.where(F.col("load") == F.lit(newest))


def append_raw(df: DataFrame, path: str) -> None:
    """Append to the raw table: a directory per load day, rows sorted by station so that row groups can be skipped."""
    df.withColumn("ingest_date", F.to_date("ingested_at")).hint("rebalance", "ingest_date").sortWithinPartitions(
        "ingest_date", "station_uid").write.mode("append").partitionBy("ingest_date").parquet(path)


def read_raw_table(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The raw table; `since` prunes directories as well as rows."""
    df = spark.read.parquet(path)
    if since is None:
        return df
    stamp = since.strftime("%Y-%m-%d %H:%M:%S")
    return df.where((F.col("ingest_date") >= F.lit(stamp[:10]).cast("date"))
                    & (F.col("ingested_at") >= F.lit(stamp).cast(df.schema["ingested_at"].dataType)))


def days_before(as_of: datetime, days: int) -> datetime:
    return as_of - timedelta(days=days)
