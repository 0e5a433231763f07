from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbflow.operators import monitor as m
from kerbflow.operators import quality as q
from tests.conftest import T0

SAMPLE = "metric string, series string, ts timestamp, value double"


def sec(n):
    return T0 + timedelta(seconds=n)


def test_suite_blocks_on_errors_only(spark):
    df = spark.createDataFrame([("a", 1, -1), ("a", None, 2), ("b", 3, 3)], "k string, bikes_available long, docks_available long")
    checks = [q.Check("unique", q.unique(df, ["k"]), "warn"), q.Check("null", q.not_null(df, "bikes_available"), "warn"),
              q.Check("values", q.accepted_values(df, "bikes_available", [1, 3]))]
    result = q.run_suite(checks)
    assert {r["check"]: (r["failures"], r["verdict"]) for r in result.collect()} == {
        "unique": (1, "warn"), "null": (1, "warn"), "values": (0, "pass")}
    q.require_passing(result)
    with pytest.raises(q.QualityError, match="negative"):
        q.require_passing(q.run_suite([*checks, q.Check("negative", q.counts_negative(df))]))


@pytest.mark.parametrize("age,verdict", [(59, "pass"), (61, "warn"), (121, "error"), (None, "error")])
def test_freshness(spark, age, verdict):
    rows = [] if age is None else [(T0 - timedelta(minutes=age),)]
    df = spark.createDataFrame(rows, "at timestamp")
    assert q.freshness(df, "at", T0, timedelta(minutes=60), timedelta(minutes=120)).first()["verdict"] == verdict


def test_counter_restart_and_silence(spark):
    rows = [("sent", "a", sec(-100 + 10 * i), float(v)) for i, v in enumerate([5, 7, 7, 2, 4])] + [("sent", "old", sec(-4000), 9.0)]
    samples = spark.createDataFrame(rows, SAMPLE)
    got = m.counter_increase(samples, T0, timedelta(minutes=30), ["series"], series=samples.select("series"))
    assert {r["series"]: r["increase"] for r in got.collect()} == {"a": 6.0, "old": 0.0}


def test_gauge_age_uses_the_last_sample_in_range(spark):
    epoch = (T0 - datetime(1970, 1, 1)).total_seconds()
    samples = spark.createDataFrame([("t", "a", sec(-50), epoch - 60), ("t", "a", sec(-20), epoch - 30), ("t", "b", sec(-7200), epoch)], SAMPLE)
    assert m.gauge_age(samples, T0, timedelta(hours=1), ["metric"]).first()["age_seconds"] == pytest.approx(30)


def test_rule_must_hold_and_no_data_alerts_or_not(spark):
    readings = spark.createDataFrame([("r", sec(60 * i + 5), v) for i, v in enumerate([1., 9., 9., 9., 1., 9.])], "rule string, ts timestamp, value double")
    rules = spark.createDataFrame([("r", 5.0, 120, True, "critical"), ("quiet", 5.0, 0, False, "warning"), ("lost", 5.0, 60, True, "critical")],
                                  "rule string, threshold double, hold_seconds int, alert_on_no_data boolean, severity string")
    got = {}
    for row in m.evaluate_rules(readings, rules, T0, sec(360), 60).orderBy("tick").collect():
        got.setdefault(row["rule"], []).append(row["state"])
    assert got["r"] == ["normal", "pending", "pending", "firing", "normal", "pending"]
    assert got["quiet"] == ["no_data"] * 6 and got["lost"] == ["pending"] + ["firing"] * 5


def test_bands(spark):
    df = spark.createDataFrame([(119.0,), (120.0,), (180.0,), (None,)], "v double")
    assert [r[0] for r in df.select(m.band(F.col("v"), [(120, "orange"), (180, "red")], "green")).collect()] == ["green", "orange", "red", None]


def test_latency_percentiles(spark):
    events = spark.createDataFrame([(T0, sec(n)) for n in (138, 130, 141, 139, 120)], "changed timestamp, detected timestamp")
    exact = m.event_latency(events, "changed", "detected").first()
    assert exact["median_seconds"] == 138 and exact["p95_seconds"] == pytest.approx(140.6)
    assert m.event_latency(events, "changed", "detected", exact=False).first()["median_seconds"] == 138
