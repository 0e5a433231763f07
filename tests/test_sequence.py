import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbflow.operators.dimension import asof_dim_join, dim_stations, scd2_apply, scd2_from_log
from kerbflow.operators.sequence import HOT, SLICE, cut_hot_keys, neighbour
from tests.conftest import T0


@pytest.fixture(scope="module")
def series(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}", rnd.randrange(10**6), i) for i in range(2000)]
    return spark.createDataFrame(rows, "key string, sec long, v long").withColumn("ts", F.timestamp_seconds("sec"))


@pytest.mark.parametrize("rows_per_slice", [10**6, 300, 25])
@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour_equals_plain_window(series, rows_per_slice, step):
    cut = cut_hot_keys(series, ["key"], ["ts", "v"], rows_per_slice)
    got = neighbour(cut, ["ts", "v"], {"v": "other"}, step).rows.select("v", "other")
    move = F.lag if step < 0 else F.lead
    want = series.select("v", move("v").over(Window.partitionBy("key").orderBy("ts", "v")).alias("other"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_only_large_keys_are_cut(series):
    cut = cut_hot_keys(series, ["key"], ["ts", "v"], 300).rows
    slices = {r["key"]: r["n"] for r in cut.groupBy("key").agg(F.count_distinct(SLICE).alias("n")).collect()}
    assert slices["hot"] >= 4 and {n for k, n in slices.items() if k != "hot"} == {1}
    assert cut.where(HOT).select("key").distinct().count() == 1


@pytest.mark.parametrize("seconds", [lambda i: 0 if i == 0 else 10**9 + i % 50, lambda i: 7])
def test_bursts_and_single_instants_are_cut_by_rows(spark, seconds):
    """One early row and a burst, and all rows of one instant: no slice holds much more than its share."""
    rows = spark.createDataFrame([("k", seconds(i), i) for i in range(4000)], "key string, sec long, v long").withColumn("ts", F.timestamp_seconds("sec"))
    cut = cut_hot_keys(rows, ["key"], ["ts", "v"], 500)
    sizes = [r["count"] for r in cut.rows.groupBy(SLICE).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 1000 and len(sizes) >= 6
    got = neighbour(cut, ["ts", "v"], {"v": "other"}).rows.select("v", "other")
    want = rows.select("v", F.lag("v").over(Window.partitionBy("key").orderBy("ts", "v")).alias("other"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_null_keys_match_nothing_in_either_form(spark, series):
    dim = spark.createDataFrame([(None, T0, None, 1), ("a", T0, None, 2)], "key string, valid_from timestamp, valid_to timestamp, size int")
    facts = spark.createDataFrame([(None, T0, 1), ("a", T0, 2), ("a", None, 3)], "key string, ts timestamp, v long")
    for method in ("pairs", "ordered"):
        assert [r["v"] for r in asof_dim_join(facts, dim, "key", "ts", ["size"], method=method).collect()] == [2]


@pytest.mark.parametrize("rows_per_slice", [10**6, 40])
def test_asof_forms_agree(spark, series, rows_per_slice):
    log = series.where("v % 7 = 0").select("key", "ts", (F.col("v") % 5).alias("size"), "v")
    dim = scd2_from_log(log, "key", "ts", ["size"], ["v"], rows_per_slice)
    facts = series.select("key", "ts", "v")
    a = asof_dim_join(facts, dim, "key", "ts", ["size"], method="pairs")
    b = asof_dim_join(facts, dim, "key", "ts", ["size"], method="ordered", rows_per_slice=rows_per_slice)
    columns = ["key", "v", "size", "valid_from"]
    assert sorted(a.select(columns).collect()) == sorted(b.select(columns).collect()) and a.count() > 1000


def test_history_has_one_open_version_and_no_gaps(series):
    dim = scd2_from_log(series.select("key", "ts", (F.col("v") % 3).alias("size"), "v"), "key", "ts", ["size"], ["v"], 100)
    per_key = dim.groupBy("key").agg(F.count_if(F.col("valid_to").isNull()).alias("open")).collect()
    assert {r["open"] for r in per_key} == {1}
    following = dim.withColumn("next", F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from")))
    assert following.where("valid_to is not null and next <> valid_to and valid_to <> valid_from").count() == 0


def test_scd2_apply_close_reopen_keep_add(spark):
    schema = "station_uid string, capacity long, name string, valid_from timestamp, valid_to timestamp"
    old = T0.replace(year=2026)
    dim = spark.createDataFrame([("keep", 1, None, old, None), ("change", 1, "x", old, None), ("gone", 1, "x", old, None),
                                 ("back", 1, "x", old, old.replace(month=12))], schema)
    now = spark.createDataFrame([("keep", 1, None), ("change", 2, "x"), ("new", 3, "y"), ("back", 1, "x")],
                                "station_uid string, capacity long, name string")
    out = {(r["station_uid"], r["capacity"], r["valid_to"] is None) for r in scd2_apply(dim, now, "station_uid", ["capacity", "name"], T0).collect()}
    assert out == {("keep", 1, True), ("change", 1, False), ("change", 2, True), ("gone", 1, False), ("new", 3, True),
                   ("back", 1, False), ("back", 1, True)}
    again = scd2_apply(scd2_apply(dim, now, "station_uid", ["capacity", "name"], T0), now, "station_uid", ["capacity", "name"], T0)
    assert again.count() == 7
    keys = dim_stations(again)
    assert keys.select("station_sk").distinct().count() == 7 and keys.where("is_current").count() == 4
