"""Type-2 dimensions and joins of facts to the version valid at their time."""

from __future__ import annotations

from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.functions.timefns import micros
from kerbflow.operators.sequence import ROWS_PER_SLICE, carry_forward, cut_hot_keys, neighbour
from kerbflow.session import store

# With more versions of one key the join runs as an ordered pass.
VERSIONS_PER_KEY = 64


def _differs(columns: list[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return ~same


def scd2_apply(dim: DataFrame, current: DataFrame, key: str, check_cols: list[str], as_of: datetime) -> DataFrame:
    """Type-2 history after one snapshot: changed keys close and reopen, missing keys close, new keys open."""
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dim.schema["valid_from"].dataType)
    attributes = [c for c in dim.columns if c not in ("valid_from", "valid_to")]
    closed = dim.where(F.col("valid_to").isNotNull())
    pair = dim.where(F.col("valid_to").isNull()).alias("o").join(
        current.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    exists_new, exists_old = F.col(f"n.{key}").isNotNull(), F.col(f"o.{key}").isNotNull()
    changed = exists_new & exists_old & _differs(check_cols, "o", "n")
    # A pair of old and new row gives one version or two: the old one (closed or kept) and a new open one.
    old_version = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in attributes], F.col("o.valid_from").alias("valid_from"),
        F.when(~exists_new | changed, now).alias("valid_to"))
    new_version = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in attributes], now.alias("valid_from"),
        F.lit(None).cast(dim.schema["valid_to"].dataType).alias("valid_to"))
    versions = F.filter(
        F.array(F.when(exists_old, old_version), F.when(~exists_old | changed, new_version)), lambda v: v.isNotNull())
    return closed.unionByName(pair.select(F.explode(versions).alias("v")).select("v.*").select(*dim.columns))


def scd2_from_log(log: DataFrame, key: str, ts: str, check_cols: list[str], tie: list[str] | None = None,
                  rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Whole type-2 history from a log of observations: one version per run of equal checked columns."""
    order = [ts, *(tie or [])]
    cut = cut_hot_keys(log, [key], order, rows_per_slice)
    seen = neighbour(cut.of(cut.rows.withColumn("__now", F.struct(*check_cols))), order, {"__now": "__before"})
    changes = seen.of(seen.rows.where(F.col("__before").isNull() | ~F.col("__now").eqNullSafe(F.col("__before"))).drop("__before"))
    linked = neighbour(changes, order, {ts: "valid_to"}, step=1).rows
    return linked.select(key, *check_cols, F.col(ts).alias("valid_from"), "valid_to")


def dim_stations(history: DataFrame, key: str = "station_uid") -> DataFrame:
    """Dimension rows: surrogate key over key and version start, and the current flag."""
    start = micros(F.col("valid_from")).cast("string")
    return history.select(
        F.md5(F.concat_ws("|", F.col(key), start)).alias("station_sk"), "*", F.col("valid_to").isNull().alias("is_current"))


def without_overlaps(dim: DataFrame, key: str, columns: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Versions (key, valid_from, valid_to, columns) of which at most one is valid at any time.

    A version ends at the latest when the next one of its key starts, also if that one closes first: the version that
    started last decides. Of versions with one start the one that ends last decides, an open one before all, then the
    one with the greatest columns. Versions without a key or a start, and those that end when they start, do not count.
    """
    lasting = dim.select(key, "valid_from", "valid_to", *columns).where(
        F.col(key).isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    ranked = lasting.withColumn("__open", F.col("valid_to").isNull())
    order = ["valid_from", "__open", "valid_to", *columns]
    linked = neighbour(cut_hot_keys(ranked, [key], order, rows_per_slice), order, {"valid_from": "__next"}, step=1).rows
    return linked.withColumn("valid_to", F.least("valid_to", "__next")).where(
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).select(key, "valid_from", "valid_to", *columns)


def asof_dim_join(fact: DataFrame, dim: DataFrame, key: str, ts: str, columns: list[str],
                  method: Literal["auto", "pairs", "ordered"] = "auto",
                  rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Facts with the attributes of the dimension version that started last at or before their time, if valid then.

    Overlaps are taken out of the dimension first (`without_overlaps`), so a fact meets one version at most and both forms
    give the same rows. With few versions a key, facts and versions are paired by key; Spark broadcasts the dimension if
    its stored size allows. Otherwise both are ordered together and the last version is carried forward, which never
    pairs all facts of a key with all of its versions. Facts without a key or a time match nothing.
    """
    versions = store(without_overlaps(dim, key, columns, rows_per_slice), "versions")
    if method == "auto":
        most = versions.groupBy(key).count().agg(F.max("count")).first()[0] or 0
        method = "pairs" if most <= VERSIONS_PER_KEY else "ordered"
    if method == "pairs":
        at = F.col(f"f.{ts}")
        return fact.alias("f").join(
            versions.alias("d"),
            (F.col(f"f.{key}") == F.col(f"d.{key}")) & (at >= F.col("d.valid_from"))
            & (F.col("d.valid_to").isNull() | (at < F.col("d.valid_to"))),
        ).select("f.*", "d.valid_from", "d.valid_to", *[f"d.{c}" for c in columns])

    dtype = fact.schema[ts].dataType
    version = F.struct(F.col("valid_from").cast(dtype).alias("valid_from"), F.col("valid_to").cast(dtype).alias("valid_to"),
                       *columns)
    as_rows = versions.select(
        F.col(key), F.col("valid_from").cast(dtype).alias(ts), F.lit(0).alias("__kind"), version.alias("__version"))
    facts = fact.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("__kind", F.lit(1))
    mixed = facts.unionByName(as_rows, allowMissingColumns=True)
    # Facts of one instant are dealt out by a hash of their content.
    mixed = mixed.withColumn("__deal", F.xxhash64(*[c for c in fact.columns if not isinstance(fact.schema[c].dataType, (T.MapType, T.VariantType))]))
    cut = cut_hot_keys(mixed, [key], [ts, "__kind", "__deal"], rows_per_slice)
    joined = carry_forward(cut, [ts, "__kind"], F.col("__version"), "__valid").rows.where("__kind = 1")
    valid = F.col("__valid")
    return joined.where(
        valid.isNotNull() & (valid["valid_to"].isNull() | (F.col(ts) < valid["valid_to"]))
    ).select(*fact.columns, "__valid.*")
