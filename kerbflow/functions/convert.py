"""Lenient conversions: what cannot be read becomes null instead of failing the batch."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(col: Column) -> Column:
    """Whole number from a number or numeric text; text, fractions and blanks give null."""
    text = F.trim(col.cast("string"))
    # Beyond 2**53 a double loses digits, so it only reads what is not written as a whole number.
    number = text.try_cast("double")
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")).otherwise(
        F.when((number == F.floor(number)) & (F.abs(number) < F.lit(2.0**53)), number.try_cast("bigint")))


def to_double(col: Column) -> Column:
    return col.cast("string").try_cast("double")


def to_utc(col: Column) -> Column:
    """ISO-8601 text, with or without offset, to an instant."""
    return F.try_to_timestamp(col)


def display_name(col: Column, prefix: str) -> Column:
    """Name without its brand prefix; a missing name becomes empty text."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), "^" + re.escape(prefix), "")


def round_to(col: Column, digits: int) -> Column:
    """Half-up rounding in plain double arithmetic: cheap, and the same in every engine."""
    scale = float(10**digits)
    return F.floor(col * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def clip(col: Column, high: Column) -> Column:
    """Keep a prediction between zero and the number of docks."""
    return F.least(F.greatest(col, F.lit(0.0)), high.cast("double"))
