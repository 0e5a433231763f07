"""Registered queries: results against SQL at the smallest scale, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry_points
from workload.check import TABLES, compare
from workload.registry import ORACLES, QUERIES

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Queries that need more rows than the smallest data set has.
ON_LARGER = {"d12_train_and_evaluate"}


@pytest.fixture(scope="module")
def connections():
    """A connection for each scale, with the tables of that scale as views."""
    duckdb = pytest.importorskip("duckdb")
    made = {}
    for scale in (SF, LARGER):
        made[scale] = duckdb.connect()
        for t in TABLES.split():
            made[scale].execute(f"create view {t} as select * from '{scale}/{t}.parquet'")
    return made


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connections, name):
    scale = LARGER if name in ON_LARGER else SF
    ok, text = compare(spark, connections[scale], name, QUERIES[name], ORACLES.get(name), scale)
    assert ok, text


def test_only_model_and_clock_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) <= {"d17_predict", "i10_stream_latency"}
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_flagship_returns_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["c7_asof_join", "c7_asof_join_ordered", "d10_training_set", "f9_knn", "f11_recommend_with_known_legs",
                                  "f15_describe_points", "f19_match_stations", "g5_relationships", "i8_rule_states"])
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["c1_fact_dedupe", "c2_latest_in_horizon", "d2_last_per_bucket", "f1_latest_availability", "f10_recommend"])
def test_ranking_is_limited_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_time_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["c9_station_hourly_lookback"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-24T05:00" in text
    assert "props" not in text and re.search(r"ReadSchema: struct<c_custkey:bigint,c_name:string>", text)


def test_ranking_points_does_not_shuffle_them(spark):
    """From the scan of the trips to their ranked arrays there is only the spread of a one-file table."""
    text = plan(QUERIES["f9_knn"](spark, SF))
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_features_of_bucketed_facts_exchange_nothing(spark):
    text = plan(QUERIES["d7_station_features_bucketed"](spark, SF))
    assert "Exchange" not in text and "Bucketed: true" in text
