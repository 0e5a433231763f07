"""Data checks. Each check is a DataFrame of failing rows; the suite reduces them to one result row each."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.timefns import lit_like, seconds_between


class QualityError(ValueError):
    """A check of severity `error` found failing rows."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys with their row count. Counts are combined before the shuffle, so hot copies are cheap.

    Rows without a value of a single column are not compared; in a key of several columns a null is a value like others.
    """
    rows = df.where(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with another value; null passes."""
    return df.where(~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value has no parent; null passes."""
    ids = parent.select(F.col(parent_column).alias(column))
    return df.where(F.col(column).isNotNull()).join(ids, column, "left_anti")


def violates(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


def counts_negative(df: DataFrame) -> DataFrame:
    return violates(df, (F.col("bikes_available") < 0) | (F.col("docks_available") < 0))


def counts_above_capacity(joined: DataFrame, since: datetime | None = None, at: str = "source_updated_at") -> DataFrame:
    """Observations joined with their station version that hold more bikes and docks than the station has.

    `since` bounds the check to recent observations; the filter reaches the scan, through the join.
    """
    if since is not None:
        joined = joined.where(F.col(at) >= lit_like(joined, at, since))
    return violates(joined, F.col("bikes_available") + F.col("docks_available") > F.col("capacity"))


def freshness(df: DataFrame, loaded_at: str, as_of: datetime, warn: timedelta, error: timedelta) -> DataFrame:
    """One row: newest load, its age and the verdict. A source without rows is an error."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    age = seconds_between(F.col("newest"), lit_like(df, loaded_at, as_of))
    return newest.withColumn("age_seconds", age).withColumn(
        "verdict",
        F.when(F.col("newest").isNull() | (F.col("age_seconds") > int(error.total_seconds())), "error")
        .when(F.col("age_seconds") > int(warn.total_seconds()), "warn").otherwise("pass"))


@dataclass(frozen=True)
class Check:
    name: str
    failing: DataFrame
    severity: str = "error"


def run_suite(checks: list[Check]) -> DataFrame:
    """One row per check: failing rows and verdict. `error` blocks, `warn` only reports."""
    rows = [
        c.failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures",
            F.when(F.col("failures") == 0, "pass").otherwise(c.severity).alias("verdict"))
        for c in checks
    ]
    return reduce(DataFrame.unionByName, rows)


def require_passing(results: DataFrame) -> None:
    """Raise when a blocking check failed. Results hold one row per check."""
    failed = [r["check"] for r in results.where(F.col("verdict") == "error").select("check").collect()]
    if failed:
        raise QualityError(f"failed checks: {', '.join(sorted(failed))}")
