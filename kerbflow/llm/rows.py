"""Feed whole texts to a small helper inside Spark tasks, a bounded piece of an Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PIECE_BYTES = 1 << 19

#: ASCII: upper case becomes lower, what is no letter or digit becomes a space; bytes of longer UTF-8 sequences stay.
FOLD_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def folded_words(text: bytes) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case."""
    return text.translate(FOLD_WORDS).split()


def pieces(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most PIECE_BYTES of text each, or one row where that alone is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > PIECE_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def under_plain_names(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with all columns but those of `keep` under names that no helper uses, and the way back.

    The way back takes a table that begins with the same columns in the same order. So a caller's columns may have any
    name, also one with a dot or one that a helper uses inside.
    """
    plain = [name if name in keep else f"carried{i}" for i, name in enumerate(docs.columns)]
    return docs.toDF(*plain), lambda found: found.toDF(*docs.columns, *found.columns[len(plain):])


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Plans that run inside send texts to Python in batches of about `size` bytes, whatever the number of rows."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of a column; a null text is empty."""
    values = batch.column(column)
    if not pa.types.is_binary(values.type) and not pa.types.is_large_binary(values.type):
        values = values.cast(pa.large_binary())
    return [x or b"" for x in values.to_pylist()]


def map_texts(docs: DataFrame, keep: list[str], text: str, make: Callable[[], Callable[..., list]], fields: str,
              use: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns and, row by row, the fields that a helper derives from the text.

    `make()` runs once per task and gives a function of a list of texts, and of one list for each column of `use`, that
    returns one list per field. Rows keep their order and number. All other columns are left out of the transfer, so
    their names cannot clash; a field replaces a kept column of its name.
    """
    added = T.StructType.fromDDL(fields)
    keep = [c for c in keep if c not in added.names]
    carried = text in keep and docs.schema[text].dataType == T.StringType()
    whole = text if carried else "_text"
    source = docs.select(*keep, *(F.col(c).alias(f"_use_{c}") for c in use),
                         *([] if carried else [F.col(text).cast("string").alias("_text")]))
    schema = T.StructType([*source.schema.fields[:len(keep)], *added.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        derive = make()
        for piece in pieces(batches, whole):
            found = derive(texts(piece, whole), *(piece.column(len(keep) + i).to_pylist() for i in range(len(use))))
            arrays = [piece.column(i) for i in range(len(keep))] + [
                pa.array(values, type=arrow.field(f.name).type) for values, f in zip(found, added.fields, strict=True)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)
