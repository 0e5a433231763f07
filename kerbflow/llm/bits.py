"""A bounded bit filter over the values of a column, built as bitmaps on the executors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits and bytes of one of Spark's bitmaps.
BITMAP, BITMAP_BYTES = 1 << 15, 1 << 12


def bits_of(rows: DataFrame, column: str, power: int) -> np.ndarray:
    """A bit for the lower `power` bits of each value of a long column; at most 2**power bits reach the driver."""
    place: Column = F.col(column).bitwiseAND(F.lit((1 << power) - 1)) + 1
    maps = (rows.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toArrow())
    out = np.zeros(max(1, (1 << power) // BITMAP) * BITMAP_BYTES, np.uint8)
    for bucket, bits in zip(maps.column("bucket").to_pylist(), maps.column("bits").to_pylist()):
        out[(bucket - 1) * BITMAP_BYTES:bucket * BITMAP_BYTES] = np.frombuffer(bits, np.uint8)
    return out


def has(bits: np.ndarray, values: np.ndarray, power: int) -> np.ndarray:
    """Whether the bits of unsigned values are set: always for those of the column, now and then for others."""
    place = values & np.uint64((1 << power) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
