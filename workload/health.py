"""Data checks and pipeline monitoring (G, I)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kerbflow.operators import monitor as m
from kerbflow.operators import quality as q
from kerbflow.operators.dimension import asof_dim_join
from workload import views as v
from workload.registry import query
from workload.views import EVENTS_AS_OF, ORDERS_AS_OF

AS_OF_SQL = "TIMESTAMP '2024-01-31'"
LINES = {"lines": "SELECT CAST(l_partkey AS VARCHAR) AS station_uid, l_orderkey, l_linenumber FROM lineitem"}
SHORT = {"short": "SELECT seq, bikes_available, 15 - bikes_available AS docks_available FROM obs"}
OVER = {"over": """
    SELECT o.seq, o.bikes_available, o.docks_available, d.capacity
    FROM obs o JOIN capacity_dim d ON d.station_uid = o.station_uid AND o.source_updated_at >= d.valid_from
     AND (d.valid_to IS NULL OR o.source_updated_at < d.valid_to)
    WHERE o.bikes_available + o.docks_available > d.capacity"""}


def lines(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("station_uid"), "l_orderkey", "l_linenumber")


def short(spark, sf):
    return v.obs(spark, sf).select("seq", "bikes_available", (F.lit(15) - F.col("bikes_available")).alias("docks_available"))


def over(spark, sf):
    joined = asof_dim_join(v.obs(spark, sf), v.capacity_dim(spark, sf), "station_uid", "source_updated_at", ["capacity"])
    return q.counts_above_capacity(joined).select("seq", "bikes_available", "docks_available", "capacity")


@query("g1_not_null", "SELECT station_uid, feature_ts FROM features WHERE bikes_change_1 IS NULL")
def g1(spark, sf):
    return q.not_null(v.features(spark, sf), "bikes_change_1").select("station_uid", "feature_ts")


@query("g2_unique", "SELECT station_uid, count(*) AS n FROM obs GROUP BY 1 HAVING count(*) > 1")
def g2(spark, sf):
    return q.unique(v.obs(spark, sf), ["station_uid"])


@query("g3_unique_key", "SELECT station_uid, source_updated_at, count(*) AS n FROM obs_raw GROUP BY 1, 2 HAVING count(*) > 1")
def g3(spark, sf):
    return q.unique(v.obs_raw(spark, sf), ["station_uid", "source_updated_at"])


@query("g3_unique_key_with_nulls", """
    SELECT o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority, count(*) AS n
    FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def g3_nulls(spark, sf):
    """A part of the key may be null; repeated keys with a null count too."""
    rows = v.table(spark, sf, "orders").select("o_custkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("priority"))
    return q.unique(rows, ["o_custkey", "priority"])


@query("g4_accepted_values", "SELECT station_uid, seq, o_orderstatus FROM station_log WHERE o_orderstatus NOT IN ('F', 'O')")
def g4(spark, sf):
    return q.accepted_values(v.station_log(spark, sf), "o_orderstatus", ["F", "O"]).select("station_uid", "seq", "o_orderstatus")


@query("g5_relationships", """
    SELECT * FROM lines l WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE s.station_uid = l.station_uid)""", **LINES)
def g5(spark, sf):
    return q.relationships(lines(spark, sf), "station_uid", v.stations(spark, sf), "station_uid")


@query("g6_counts_negative", "SELECT * FROM short WHERE bikes_available < 0 OR docks_available < 0", **SHORT)
def g6(spark, sf):
    return q.counts_negative(short(spark, sf))


@query("g7_counts_above_capacity", "SELECT * FROM over", **OVER)
def g7(spark, sf):
    return over(spark, sf)


@query("g7_counts_above_capacity_last_day", """
    SELECT over.* FROM over JOIN obs USING (seq) WHERE source_updated_at >= TIMESTAMP '2024-01-30'""", **OVER)
def g7_recent(spark, sf):
    """The daily run looks at the last day only."""
    joined = asof_dim_join(v.obs(spark, sf), v.capacity_dim(spark, sf), "station_uid", "source_updated_at", ["capacity"])
    return q.counts_above_capacity(joined, EVENTS_AS_OF - timedelta(days=1)).select("seq", "bikes_available", "docks_available", "capacity")


@query("g8_freshness", f"""
    SELECT newest, age_seconds, CASE WHEN age_seconds > 7200 THEN 'error' WHEN age_seconds > 300 THEN 'warn' ELSE 'pass' END AS verdict
    FROM (SELECT max(source_updated_at) AS newest,
                 CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(max(source_updated_at))) / 1000000) AS BIGINT) AS age_seconds FROM obs)""")
def g8(spark, sf):
    return q.freshness(v.obs(spark, sf), "source_updated_at", EVENTS_AS_OF, timedelta(minutes=5), timedelta(minutes=120))


@query("g9_suite", """
    SELECT "check", severity, failures, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS verdict FROM (
      SELECT 'station_uid not null' AS "check", 'error' AS severity, count(*) AS failures FROM obs WHERE station_uid IS NULL
      UNION ALL SELECT 'fact key unique', 'error', count(*) FROM (SELECT 1 FROM fact GROUP BY station_uid, source_updated_at HAVING count(*) > 1)
      UNION ALL SELECT 'counts valid', 'error', count(*) FROM short WHERE bikes_available < 0 OR docks_available < 0
      UNION ALL SELECT 'station known', 'warn', count(*) FROM lines l WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE s.station_uid = l.station_uid)
      UNION ALL SELECT 'within capacity', 'warn', count(*) FROM over)""", **LINES, **SHORT, **OVER)
def g9(spark, sf):
    return q.run_suite([
        q.Check("station_uid not null", q.not_null(v.obs(spark, sf), "station_uid")),
        q.Check("fact key unique", q.unique(v.fact(spark, sf), ["station_uid", "source_updated_at"])),
        q.Check("counts valid", q.counts_negative(short(spark, sf))),
        q.Check("station known", q.relationships(lines(spark, sf), "station_uid", v.stations(spark, sf), "station_uid"), "warn"),
        q.Check("within capacity", over(spark, sf), "warn"),
    ])


YEARS = timedelta(days=2500)


@query("i1_run_summary", """
    SELECT job, count(*) FILTER (WHERE state = 'success') AS successes, count(*) FILTER (WHERE state = 'failed') AS failures,
           max(ended_at) FILTER (WHERE state = 'success') AS last_success,
           avg(CAST(epoch(ended_at) - epoch(started_at) AS DOUBLE)) FILTER (WHERE state = 'success') AS mean_seconds,
           CAST(epoch(TIMESTAMP '2001-08-02') - epoch(max(ended_at) FILTER (WHERE state = 'success')) AS BIGINT) AS seconds_since_success
    FROM job_runs WHERE due_at > TIMESTAMP '2001-08-02' - INTERVAL 2500 DAY GROUP BY 1""")
def i1(spark, sf):
    return m.run_summary(v.job_runs(spark, sf), ORDERS_AS_OF, YEARS)


@query("i2_recent_failures", """
    SELECT count(*) AS value FROM job_runs WHERE state = 'failed' AND ended_at > TIMESTAMP '2001-08-02' - INTERVAL 10 DAY""")
def i2(spark, sf):
    return m.recent_failures(v.job_runs(spark, sf), ORDERS_AS_OF, timedelta(days=10))


@query("i3_seconds_since_success", """
    SELECT job, CAST(epoch(TIMESTAMP '2001-08-02') - epoch(max(ended_at)) AS BIGINT) AS value
    FROM job_runs WHERE state = 'success' GROUP BY 1""")
def i3(spark, sf):
    return m.seconds_since_success(v.job_runs(spark, sf), ORDERS_AS_OF)


IN_RANGE = f"ts > {AS_OF_SQL} - INTERVAL 31 DAY AND ts <= {AS_OF_SQL}"
MONTH = timedelta(days=31)


@query("i4_last_over_time", f"""
    SELECT metric, series, ts, value FROM metric_samples WHERE {IN_RANGE}
    QUALIFY row_number() OVER (PARTITION BY metric, series ORDER BY ts DESC, value DESC) = 1""")
def i4(spark, sf):
    return m.last_over_time(v.metric_samples(spark, sf), EVENTS_AS_OF, MONTH, ["metric", "series"])


@query("i5_gauge_age", f"""
    SELECT metric, CAST(floor(epoch({AS_OF_SQL}) - max(gauge)) AS BIGINT) AS age_seconds FROM (
      SELECT metric, series, epoch(ts) AS gauge FROM metric_samples WHERE {IN_RANGE}
      QUALIFY row_number() OVER (PARTITION BY metric, series ORDER BY ts DESC) = 1) GROUP BY 1""")
def i5(spark, sf):
    """Gauges that hold a time: the newest of each metric."""
    gauges = v.metric_samples(spark, sf).withColumn("value", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    ages = m.gauge_age(gauges, EVENTS_AS_OF, MONTH, ["metric"])
    return ages.select("metric", F.floor("age_seconds").alias("age_seconds"))


INCREASE = f"""
    SELECT metric, CAST(round(coalesce(sum(CASE WHEN c < b THEN c ELSE c - b END), 0)) AS BIGINT) AS increase
    FROM (SELECT metric, floor(value) AS c, lag(floor(value)) OVER (PARTITION BY metric ORDER BY ts, floor(value)) AS b
          FROM metric_samples WHERE {IN_RANGE}) GROUP BY 1"""


def _counters(spark, sf):
    return v.metric_samples(spark, sf).withColumn("value", F.floor("value").cast("double"))


@query("i6_counter_increase", INCREASE)
def i6(spark, sf):
    """Counters that fall often; few series with many samples each."""
    return m.counter_increase(_counters(spark, sf), EVENTS_AS_OF, MONTH, ["metric"]).select(
        "metric", F.round("increase").cast("bigint").alias("increase"))


@query("i6_counter_increase_hot_series", INCREASE)
def i6_hot(spark, sf):
    """The same with each series cut into slices."""
    return m.counter_increase(_counters(spark, sf), EVENTS_AS_OF, MONTH, ["metric"], rows_per_slice=100).select(
        "metric", F.round("increase").cast("bigint").alias("increase"))


@query("i6_counter_increase_with_silent_series", f"""
    SELECT s.series, coalesce(CAST(round(sum(CASE WHEN c < b THEN c ELSE c - b END)) AS BIGINT), 0) AS increase
    FROM (SELECT DISTINCT series FROM metric_samples) s LEFT JOIN (
      SELECT series, floor(value) AS c, lag(floor(value)) OVER (PARTITION BY series ORDER BY ts, floor(value)) AS b
      FROM metric_samples WHERE ts > {AS_OF_SQL} - INTERVAL 1 DAY AND ts <= {AS_OF_SQL}) x USING (series) GROUP BY 1""")
def i6_silent(spark, sf):
    """Over one day; a known series without samples counts zero."""
    counters = _counters(spark, sf)
    return m.counter_increase(counters, EVENTS_AS_OF, timedelta(days=1), ["series"], series=counters.select("series")).select(
        "series", F.round("increase").cast("bigint").alias("increase"))


@query("i7_live_targets", f"""
    SELECT CAST(sum(up) AS DOUBLE) AS value FROM (
      SELECT CASE WHEN value >= 10 THEN 1 ELSE 0 END AS up FROM metric_samples WHERE {IN_RANGE}
      QUALIFY row_number() OVER (PARTITION BY metric, series ORDER BY ts DESC) = 1)""")
def i7(spark, sf):
    up = v.metric_samples(spark, sf).withColumn("value", F.when(F.col("value") >= 10, 1.0).otherwise(0.0))
    return m.live_targets(up, EVENTS_AS_OF, MONTH)


@query("i8_rule_states", f"""
    SELECT rule, severity, tick, value, breached,
           CASE WHEN NOT breached THEN CASE WHEN value IS NULL THEN 'no_data' ELSE 'normal' END
                WHEN epoch(tick) - epoch(began) >= hold THEN 'firing' ELSE 'pending' END AS state
    FROM (SELECT *, min(CASE WHEN breached THEN tick END) OVER (PARTITION BY rule, island ORDER BY tick) AS began
      FROM (SELECT *, sum(CASE WHEN breached THEN 0 ELSE 1 END) OVER (PARTITION BY rule ORDER BY tick) AS island
        FROM (SELECT g.rule, g.severity, g.hold, g.tick, r.value, coalesce(r.value > g.threshold, g.alarm) AS breached
          FROM (SELECT rule, severity, threshold, hold, alarm, t AS tick FROM rules,
                range(TIMESTAMP '2024-01-01', {AS_OF_SQL}, INTERVAL 600 SECOND) AS x(t)) g
          LEFT JOIN (SELECT metric AS rule, {v.sql_bucket('ts', 600)} AS tick, arg_max(value, ts) AS value
                     FROM metric_samples WHERE ts >= TIMESTAMP '2024-01-01' AND ts < {AS_OF_SQL} GROUP BY 1, 2) r
          ON r.rule = g.rule AND r.tick = g.tick)))""", rules="""
    SELECT event_type AS rule, CASE WHEN event_type = 'error' THEN 'critical' ELSE 'warning' END AS severity,
           avg(CAST(floor(value) AS BIGINT)) AS threshold, CASE WHEN event_type IN ('click', 'view') THEN 600 ELSE 1200 END AS hold,
           event_type IN ('error', 'view') AS alarm
    FROM events GROUP BY 1""")
def i8(spark, sf):
    """One rule per metric with its mean as threshold; ticks of ten minutes over the month."""
    events = v.table(spark, sf, "events")
    kind = F.col("rule")
    rules = events.groupBy(F.col("event_type").alias("rule")).agg(
        F.avg(F.floor("value")).alias("threshold")).select(
        "rule", "threshold", F.when(kind == "error", "critical").otherwise("warning").alias("severity"),
        F.when(kind.isin("click", "view"), 600).otherwise(1200).alias("hold_seconds"),
        kind.isin("error", "view").alias("alert_on_no_data"))
    readings = v.metric_samples(spark, sf).select(F.col("metric").alias("rule"), "ts", "value")
    return m.evaluate_rules(readings, rules, datetime(2024, 1, 1), EVENTS_AS_OF, 600)


@query("i9_bands", """
    SELECT event_id, CASE WHEN value >= 60 THEN 'red' WHEN value >= 20 THEN 'orange' ELSE 'green' END AS colour FROM events""")
def i9(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", m.band(F.col("value"), [(20, "orange"), (60, "red")], "green").alias("colour"))
