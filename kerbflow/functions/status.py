"""Station status rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four states of a station.
NORMAL, EMPTY, FULL, OUT_OF_SERVICE = "normal", "empty", "full", "out_of_service"

# Fixed value: fewer than this many bikes or docks is a risk.
LOW_THRESHOLD = 3


def in_service(status: Column) -> Column:
    return status == F.lit(1)


def classify(bikes: Column, docks: Column, status: Column) -> Column:
    """State of one observation. A missing service status counts as out of service."""
    return (
        F.when(~status.eqNullSafe(F.lit(1)), OUT_OF_SERVICE)
        .when(bikes == 0, EMPTY)
        .when(docks == 0, FULL)
        .otherwise(NORMAL)
    )


def availability_level(is_open: Column, count: Column, low: int = LOW_THRESHOLD) -> Column:
    """Display level of the bikes or the docks of a station."""
    return F.when(~is_open, "closed").when(count == 0, "none").when(count < low, "low").otherwise("ok")
