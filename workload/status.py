"""Status classification, transitions, window statistics, streams and the dashboards over them (E, H)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kerbflow.functions.status import classify
from kerbflow.functions.timefns import lit_like
from kerbflow.operators.transitions import advance_status, status_events_batch
from kerbflow.plans import dashboards as dash
from kerbflow.schemas import STATUS_EVENT
from kerbflow.session import prepare, scratch_dir, store
from kerbflow.sources.landing import to_ndjson_column
from kerbflow.streaming import jobs
from kerbflow.streaming.progress import ProgressLog, read_samples
from kerbflow.streaming.stateful import status_events as stateful_events
from workload import views as v
from workload.registry import query
from workload.views import EVENTS_AS_OF

START, END = datetime(2024, 1, 1), datetime(2024, 1, 31)


def stream_obs(spark, sf):
    """The events table as a file stream of observations."""
    schema = prepare(spark).read.parquet(f"{sf}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    bikes = F.least(F.floor(F.col("value") / 5), F.lit(20)).cast("int")
    return jobs.usable(raw.select(
        F.col("user_id").cast("string").alias("station_uid"), F.col("ts").cast("timestamp").alias("source_updated_at"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).cast("int").alias("service_status"),
        bikes.alias("bikes_available"), (F.lit(20) - bikes).cast("int").alias("docks_available")))


EVENTS_INT = """
    SELECT station_uid, status, previous_status, changed_at, previous_duration_seconds,
           CAST(bikes_available AS INTEGER) AS bikes_available, CAST(docks_available AS INTEGER) AS docks_available
    FROM status_events"""
CLOSED = """
    SELECT station_uid, window_start, window_end, observations, avg_bikes_available,
           CAST(min_bikes_available AS INTEGER) AS min_bikes_available,
           CAST(max_bikes_available AS INTEGER) AS max_bikes_available, avg_docks_available, empty_observations,
           full_observations
    FROM half_hours WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


@query("e1_window_stats_stream", CLOSED)
def e3_stream(spark, sf):
    """Parse, watermark, dedupe and tumbling statistics as a stream into a keyed table; closed windows only."""
    root = scratch_dir(spark, "stream")
    table = jobs.window_table(spark, f"{root}/stats")
    stats = jobs.window_stats(jobs.dedupe_stream(stream_obs(spark, sf)))
    jobs.start_sink(stats, "window_stats", jobs.upsert_sink(table), f"{root}/cp", None).awaitTermination()
    return table.read().drop("updated_at")


@query("e1_window_stats_json_stream", CLOSED)
def e1_json(spark, sf):
    """The same from JSON messages: every one comes twice, among lines that cannot be read."""
    root, rows = scratch_dir(spark, "stream"), v.obs(spark, sf)
    lines = rows.select(to_ndjson_column(["station_uid", "service_status", "bikes_available", "docks_available", "source_updated_at"]).alias("value"))
    broken = rows.select(F.when(F.col("seq") % 2 == 0, "{").otherwise(F.concat(F.lit('{"station_uid": '), "station_uid", F.lit(', "bikes'))).alias("value"))
    lines.unionByName(lines).unionByName(broken).write.text(f"{root}/in")
    messages = jobs.read_messages(spark, {"kind": "files", "path": f"{root}/in"})
    table = jobs.window_table(spark, f"{root}/stats")
    stats = jobs.window_stats(jobs.dedupe_stream(jobs.parse_observations(messages)))
    jobs.start_sink(stats, "window_stats", jobs.upsert_sink(table), f"{root}/cp", None).awaitTermination()
    return table.read().drop("updated_at")


@query("e3_window_stats_batch", "SELECT * FROM half_hours")
def e3(spark, sf):
    return v.half_hours(spark, sf)


@query("e4_classify", """
    SELECT event_id, CASE WHEN s IS DISTINCT FROM 1 THEN 'out_of_service' WHEN b = 0 THEN 'empty' WHEN b = 20 THEN 'full'
                          ELSE 'normal' END AS status
    FROM (SELECT event_id, least(floor(value / 5), 20) AS b,
                 CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN NULL ELSE 1 END AS s FROM events)""")
def e4(spark, sf):
    """With missing service status (signup) as well as closed stations (error)."""
    bikes = F.least(F.floor(F.col("value") / 5), F.lit(20))
    status = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") != "signup", 1)
    return v.table(spark, sf, "events").select("event_id", classify(bikes, F.lit(20) - bikes, status).alias("status"))


@query("e5_status_events_stateful_stream", EVENTS_INT)
def e5(spark, sf):
    """The detector as a keyed stateful operator of a stream."""
    root = scratch_dir(spark, "stream")
    table = jobs.event_table(spark, f"{root}/events")
    found = stateful_events(stream_obs(spark, sf))
    jobs.start_sink(found, "status_events", jobs.insert_sink(table), f"{root}/cp", None).awaitTermination()
    return table.read().drop("detected_at")


@query("e5_status_events_table_stream", EVENTS_INT)
def e5_tables(spark, sf):
    """The detector as a micro-batch step over state tables."""
    root = scratch_dir(spark, "stream")
    table = jobs.event_table(spark, f"{root}/events")
    sink = jobs.status_sink(table, f"{root}/state")
    jobs.start_sink(stream_obs(spark, sf), "status_events", sink, f"{root}/cp", None).awaitTermination()
    return table.read().drop("detected_at")


@query("e5_advance_state", "SELECT * FROM status_events")
def e5_steps(spark, sf):
    """Two batches with carried state, the second overlapping the first, give the events of the whole history."""
    obs = v.obs(spark, sf)
    at = F.col("source_updated_at")
    first = obs.where(at < lit_like(obs, "source_updated_at", datetime(2024, 1, 16)))
    second = obs.where(at >= lit_like(obs, "source_updated_at", datetime(2024, 1, 14)))
    empty = spark.createDataFrame([], jobs.STATE_TABLE)
    early, state = advance_status(empty, first, ["seq"])
    late, _ = advance_status(store(state, "state"), second, ["seq"])
    return early.unionByName(late)


@query("e5_final_state", """
    SELECT station_uid, (SELECT status FROM changes c WHERE c.station_uid = o.station_uid ORDER BY source_updated_at DESC LIMIT 1) AS status,
           (SELECT max(epoch_us(source_updated_at)) FROM changes c WHERE c.station_uid = o.station_uid) AS since_us,
           max(epoch_us(source_updated_at)) AS last_seen_us
    FROM obs o GROUP BY station_uid""")
def e5_state(spark, sf):
    """Keyed state after two batches: status, since when, and last time seen, as epoch microseconds."""
    obs = v.obs(spark, sf)
    at = F.col("source_updated_at")
    cut = lit_like(obs, "source_updated_at", datetime(2024, 1, 16))
    empty = spark.createDataFrame([], jobs.STATE_TABLE)
    _, state = advance_status(empty, obs.where(at < cut), ["seq"])
    return advance_status(store(state, "state"), obs.where(at >= cut), ["seq"])[1]


@query("e6_status_events_batch", "SELECT * FROM status_events")
def e6(spark, sf):
    return v.status_events(spark, sf)


@query("e6_status_events_hot_keys", "SELECT * FROM status_events")
def e6_hot(spark, sf):
    """The same with every station treated as too large for one task."""
    return status_events_batch(v.obs(spark, sf), ["seq"], rows_per_slice=10)


@query("e9_run_stream", """
    SELECT 'events' AS result, count(*) AS n FROM status_events UNION ALL
    SELECT 'windows', count(*) FROM half_hours WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def e9(spark, sf):
    """Both queries side by side from one source, each with its own checkpoint."""
    root = scratch_dir(spark, "stream")
    jobs.wait_all(jobs.run_stream(spark, stream_obs(spark, sf), root, trigger_seconds=None))
    events, windows = jobs.event_table(spark, f"{root}/status_events"), jobs.window_table(spark, f"{root}/window_stats")
    return events.read().agg(F.count(F.lit(1)).alias("n")).withColumn("result", F.lit("events")).unionByName(
        windows.read().agg(F.count(F.lit(1)).alias("n")).withColumn("result", F.lit("windows")))


@query("e10_stream_progress", """
    SELECT 'window_stats' AS series, CAST(count(*) AS DOUBLE) AS input_rows,
           CAST(epoch_us(max(ts)) // 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS max_event_timestamp,
           CAST(epoch_us(max(ts)) // 1000 - 600000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS watermark_timestamp FROM events""")
def e10(spark, sf):
    """Reports of a stream over the events: rows read in all, greatest event time and watermark, in whole milliseconds."""
    root = scratch_dir(spark, "stream")
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        table = jobs.window_table(spark, f"{root}/stats")
        stats = jobs.window_stats(jobs.dedupe_stream(stream_obs(spark, sf)))
        query = jobs.start_sink(stats, "window_stats", jobs.upsert_sink(table), f"{root}/cp", None)
        query.awaitTermination()
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    samples = read_samples(spark, f"{root}/progress")
    of = lambda agg, metric: agg(F.when(F.col("metric") == metric, F.col("value"))).alias(metric)
    return samples.groupBy("series").agg(of(F.sum, "input_rows"), of(F.max, "max_event_timestamp"), of(F.max, "watermark_timestamp"))


def _stream_of_files(spark, root, *parts):
    """Observations of a file stream that takes one part a batch."""
    for part in parts:
        part.withColumn("source_updated_at", F.col("source_updated_at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    return jobs.usable(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"))


@query("e8_written_rows", """
    SELECT 'status_events' AS series, CAST(count(*) AS DOUBLE) AS written_rows, TRUE AS last_write_known FROM status_events UNION ALL
    SELECT 'window_stats', CAST(count(*) AS DOUBLE), TRUE FROM half_hours WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def e8(spark, sf):
    """What both sinks of a stream say they have written, as monitoring reads it."""
    root = scratch_dir(spark, "stream")
    jobs.wait_all(jobs.run_stream(spark, stream_obs(spark, sf), root, trigger_seconds=None))
    of = lambda agg, metric: agg(F.when(F.col("metric") == metric, F.col("value")))
    return spark.read.parquet(f"{root}/written").groupBy("series").agg(
        of(F.sum, "written_rows").alias("written_rows"),
        (of(F.max, "last_write_timestamp") > 0).alias("last_write_known"))


@query("e11_late_rows", """
    SELECT 'window_stats' AS series, CAST(count(*) AS DOUBLE) AS late_rows FROM events
    WHERE event_id % 2 = 0 AND epoch_us(ts) <= ((SELECT epoch_us(max(ts)) FROM events WHERE event_id % 4 = 1) // 1000 - 600000) * 1000""")
def e11(spark, sf):
    """Every other observation comes two batches later, behind the watermark of the first one: how many rows were too late."""
    root, rows = scratch_dir(spark, "stream"), v.obs(spark, sf)
    observations = _stream_of_files(spark, root, rows.where("seq % 4 = 1"), rows.where("seq % 4 = 3"), rows.where("seq % 2 = 0"))
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        table = jobs.window_table(spark, f"{root}/stats")
        query = jobs.start_sink(jobs.window_stats(jobs.dedupe_stream(observations)), "window_stats", jobs.upsert_sink(table), f"{root}/cp", None)
        query.awaitTermination()
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    return read_samples(spark, f"{root}/progress").where("metric = 'late_rows'").groupBy("series").agg(F.sum("value").alias("late_rows"))


@query("a14_change_feed_stream", "SELECT station_uid, source_updated_at, seq FROM obs")
def a14_stream(spark, sf):
    """A change feed over two fetches, the second of which repeats two days: every row is delivered once."""
    root, rows = scratch_dir(spark, "stream"), v.obs(spark, sf)
    at = F.col("source_updated_at")
    fetches = (rows.where(at < lit_like(rows, "source_updated_at", datetime(2024, 1, 16))),
               rows.where(at >= lit_like(rows, "source_updated_at", datetime(2024, 1, 14))))
    send = lambda fresh, number: fresh.write.mode("overwrite").parquet(f"{root}/sent/batch={number}")
    jobs.start_sink(_stream_of_files(spark, root, *fetches), "change_feed", jobs.change_sink(send, f"{root}/marks"), f"{root}/cp", None).awaitTermination()
    return spark.read.parquet(f"{root}/sent").select("station_uid", "source_updated_at", "seq")


@query("i10_stream_latency")
def i10_stream(spark, sf):
    """Source time to write time of the events of a stream, by status; the write time is the clock's."""
    from kerbflow.operators.monitor import event_latency
    root = scratch_dir(spark, "stream")
    table = jobs.event_table(spark, f"{root}/events")
    sink = jobs.status_sink(table, f"{root}/state")
    jobs.start_sink(stream_obs(spark, sf), "status_events", sink, f"{root}/cp", None).awaitTermination()
    return event_latency(table.read(), "changed_at", "detected_at", ["status"], exact=False)


@query("i10_stream_latency_counts", "SELECT status, count(*) AS events, TRUE AS written_after_change FROM status_events GROUP BY 1")
def i10_stream_counts(spark, sf):
    """Of the same stream what does not depend on the clock: events by status, none written before it happened."""
    found = i10_stream(spark, sf)
    return found.select("status", "events", ((F.col("median_seconds") >= 0) & (F.col("p95_seconds") >= F.col("median_seconds"))).alias("written_after_change"))


@query("h1_status_counts", """
    SELECT count(*) FILTER (WHERE status = 'empty') AS empty, count(*) FILTER (WHERE status = 'full') AS full,
           count(*) FILTER (WHERE status = 'out_of_service') AS out_of_service
    FROM (SELECT * FROM status_events QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY changed_at DESC) = 1)""")
def h1(spark, sf):
    return dash.status_counts(v.status_events(spark, sf))


@query("h1_current_status", """
    SELECT * FROM status_events QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY changed_at DESC) = 1""")
def h1_rows(spark, sf):
    return dash.current_status(v.status_events(spark, sf))


@query("h2_recent_transitions", """
    SELECT count(*) AS value FROM status_events
    WHERE previous_status IS NOT NULL AND changed_at > TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR""")
def h2(spark, sf):
    return dash.recent_transitions(v.status_events(spark, sf), EVENTS_AS_OF)


@query("h3_window_shares", """
    SELECT window_start, sum(empty_observations) / sum(observations) AS empty_share,
           sum(full_observations) / sum(observations) AS full_share
    FROM half_hours WHERE window_start BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31' GROUP BY 1""")
def h3(spark, sf):
    return dash.window_shares(v.half_hours(spark, sf), START, END)


@query("h4_window_totals", """
    SELECT window_start, CAST(round(sum(avg_bikes_available) * 100) AS BIGINT) AS hundredths
    FROM half_hours WHERE window_start BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31' GROUP BY 1""")
def h4(spark, sf):
    totals = dash.window_totals(v.half_hours(spark, sf), START, END)
    return totals.select("window_start", F.round(F.col("bikes") * 100).cast("bigint").alias("hundredths"))


@query("h5_transitions_over_time", f"""
    SELECT {v.sql_bucket('changed_at', 1800)} AS time,
           CASE status WHEN 'empty' THEN 'became empty' WHEN 'full' THEN 'became full' WHEN 'normal' THEN 'back to normal'
                       ELSE 'out of service' END AS metric, count(*) AS value
    FROM status_events WHERE previous_status IS NOT NULL
      AND changed_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31' GROUP BY 1, 2""")
def h5(spark, sf):
    return dash.transitions_over_time(v.status_events(spark, sf), START, END)


@query("h6_longest_ongoing", """
    SELECT coalesce(n.station_name, s.station_uid) AS station, status, changed_at,
           CAST(floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(changed_at)) / 1000000) AS BIGINT) AS seconds
    FROM (SELECT * FROM status_events QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY changed_at DESC) = 1) s
    LEFT JOIN (SELECT station_uid, CASE WHEN service_type < 20 THEN station_name END AS station_name FROM stations) n
      ON n.station_uid = s.station_uid
    WHERE status IN ('empty', 'full') ORDER BY changed_at, s.station_uid LIMIT 20""")
def h6(spark, sf):
    """Some stations lack a name, and show their id."""
    named = v.stations(spark, sf).withColumn("station_name", F.when(F.col("service_type") < 20, F.col("station_name")))
    return dash.longest_ongoing(v.status_events(spark, sf), named, EVENTS_AS_OF)


@query("h7_most_often_empty", f"""
    SELECT coalesce(n.station_name, w.station_uid) AS station, empty_share, avg_bikes, observations
    FROM (SELECT station_uid, sum(empty_observations) / sum(observations) AS empty_share,
                 {v.sql_round('avg(avg_bikes_available)', 1)} AS avg_bikes, CAST(sum(observations) AS BIGINT) AS observations
          FROM half_hours WHERE window_start BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'
          GROUP BY 1 ORDER BY empty_share DESC, observations DESC, station_uid LIMIT 20) w
    LEFT JOIN stations n ON n.station_uid = w.station_uid""")
def h7(spark, sf):
    return dash.most_often_empty(v.half_hours(spark, sf), v.stations(spark, sf), START, END)


@query("i10_event_latency", """
    SELECT status, count(*) AS events, quantile_cont(delay, 0.5) AS median_seconds, quantile_cont(delay, 0.95) AS p95_seconds
    FROM (SELECT status, 60 + coalesce(previous_duration_seconds, 0) % 600 AS delay FROM status_events) GROUP BY 1""")
def i10(spark, sf):
    """Write times some 1 to 11 minutes after the change, taken from the events themselves."""
    from kerbflow.operators.monitor import event_latency
    events = v.status_events(spark, sf)
    delay = (F.lit(60) + F.coalesce("previous_duration_seconds", F.lit(0)) % 600).cast("int")
    written = events.withColumn("detected_at", F.col("changed_at") + F.make_interval(mins=F.floor(delay / 60).cast("int"), secs=(delay % 60).cast("decimal(18,6)")))
    return event_latency(written, "changed_at", "detected_at", ["status"])

