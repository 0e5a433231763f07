"""Neighbours in a time-ordered sequence, safe for keys of any size.

A plain `lag` over one key orders all rows of that key in one task. Here a key with too many rows is cut into slices of
equal row counts along the full order, ties included, so neither a burst nor a single instant can fill one. The rows of
such keys are dealt out by ranges of the order, whose bounds Spark takes from a sample of it, to as many partitions as the
session shuffles to; each is sorted and cut by row number into as many slices as it needs. Slices are then ordered in
parallel, and the value that crosses from one slice into the next is carried over by a table of slice edges, scanned in
two levels: inside a range, and from range to range. The results are those of the plain window.

The size of a slice is fixed, so their number grows with the data, while partitions and files do not. Edges are joined as
Spark sees fit by their true size; no broadcast is asked for. Where no key is that large, the plain window runs and
nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.session import store

ROWS_PER_SLICE = 2_000_000

HOT, SLICE = "__hot", "__slice"
#: Slices are numbered from range times this on.
_PLACES = 1 << 33


@dataclass(frozen=True)
class Cut:
    """Rows, and whether some of their keys are cut: then the columns HOT and SLICE say where a row belongs."""

    rows: DataFrame
    key: list[str]
    sliced: bool

    def of(self, rows: DataFrame) -> Cut:
        """Rows derived from these, one for one or fewer, in the same places."""
        return replace(self, rows=rows)

    @property
    def parts(self) -> list[str]:
        return [*self.key, HOT, SLICE] if self.sliced else self.key

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in (HOT, SLICE)]


def cut_hot_keys(df: DataFrame, key: list[str], order: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> Cut:
    """Place the rows: usual keys stay whole, keys that are too large for one task become slices along `order`.

    Counting the rows per key is one aggregation. If a key is cut, the rows are read a second time and written, and those
    of cut keys are ordered from there and written again.
    """
    large = store(df.groupBy(*key).count().where(F.col("count") > rows_per_slice), "large-keys")
    total = large.agg(F.sum("count")).first()[0]
    if not total:
        return Cut(df, key, False)
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}")) for k in key]
    marked = store(df.alias("r").join(large.select(*key, F.lit(True).alias(HOT)).alias("l"), same, "left")
                   .select("r.*", F.coalesce(HOT, F.lit(False)).alias(HOT)), "marked-rows")
    spark = df.sparkSession
    ranges = min(-(-total // rows_per_slice), max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    # The id of a sorted row has its range in the upper bits and its place there in the lower ones.
    placed = marked.where(HOT).repartitionByRange(ranges, *key, *order).sortWithinPartitions(*key, *order).withColumn("__id", F.monotonically_increasing_id())
    number = F.col("__id").bitwiseAND(F.lit(_PLACES - 1))
    placed = placed.withColumn(SLICE, F.col("__id") - number + F.floor(number / F.lit(rows_per_slice))).drop("__id")
    placed = store(placed, "sliced-rows")
    return Cut(placed.unionByName(marked.where(~F.col(HOT)).withColumn(SLICE, F.lit(0).cast("long"))), key, True)


def neighbour(cut: Cut, order: list[str], columns: dict[str, str], step: int = -1) -> Cut:
    """Add the values of the row before (`step=-1`) or after (`step=1`) in the same key.

    `columns` maps source columns to the names of the added ones.
    """
    back = step < 0
    move = F.lag if back else F.lead
    packed = F.struct(*[F.col(c).alias(new) for c, new in columns.items()])
    within = cut.rows.withColumn("__near", move(packed).over(Window.partitionBy(*cut.parts).orderBy(*order)))
    if not cut.sliced:
        return cut.of(within.select(*cut.rows.columns, *[F.col("__near")[new].alias(new) for new in columns.values()]))
    edge = F.max_by if back else F.min_by
    edges = cut.rows.where(F.col(HOT)).groupBy(*cut.parts).agg(edge(packed, F.struct(*order)).alias("__edge"))
    return cut.of(_across(cut, within, edges, move, edge).select(
        "r.*", *[F.coalesce("__near", "__carried")[new].alias(new) for new in columns.values()]).drop("__near"))


def carry_forward(cut: Cut, order: list[str], value: Column, name: str) -> Cut:
    """Add the latest non-null `value` at or before each row of the same key, across slices."""
    window = Window.partitionBy(*cut.parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = cut.rows.withColumn("__near", F.last(value, ignorenulls=True).over(window))
    if not cut.sliced:
        return cut.of(within.withColumnRenamed("__near", name))
    edges = cut.rows.where(F.col(HOT)).groupBy(*cut.parts).agg(
        F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias("__edge"))
    return cut.of(_across(cut, within, edges, None, F.max_by).select("r.*", F.coalesce("__near", "__carried").alias(name)).drop("__near"))


def _across(cut: Cut, within: DataFrame, edges: DataFrame, move: Callable[[str], Column] | None,
            outermost: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows (as r) with `__carried`: the edge that comes over from other slices of their key.

    `move` takes the edge of the next slice on that side; without it, the last edge before that is not null comes. Edges
    are scanned inside a range, and one edge of each range (the `outermost`) from range to range.
    """
    def scanned(rows: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(order)
        value = (move("__edge").over(window) if move
                 else F.last("__edge", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1)))
        return rows.withColumn(name, value)

    edges = edges.withColumn("__range", F.floor(F.col(SLICE) / F.lit(_PLACES)))
    inside = scanned(edges, [*cut.key, "__range"], SLICE, "__inside")
    ranges = edges.groupBy(*cut.key, "__range").agg(outermost("__edge", F.when(F.col("__edge").isNotNull(), F.col(SLICE))).alias("__edge"))
    outside = scanned(ranges, cut.key, "__range", "__outside").drop("__edge")
    met = [F.col(f"i.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*cut.key, "__range"]]
    across = inside.alias("i").join(outside.alias("o"), met, "left").select(
        *[F.col(f"i.{c}").alias(c) for c in cut.parts], F.coalesce("i.__inside", "o.__outside").alias("__carried"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in cut.parts]
    return within.alias("r").join(across.alias("e"), same, "left")
