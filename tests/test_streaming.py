import json
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from kerbflow.operators.transitions import status_events_batch
from kerbflow.streaming import jobs
from kerbflow.streaming.progress import ProgressLog, read_samples
from kerbflow.streaming.stateful import status_events
from tests.conftest import T0
from tests.test_transitions import ARRIVAL, dedupe, random_rows, seen


def message(uid, minute, bikes, docks, status=1):
    at = (T0 + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
    return json.dumps({"station_uid": uid, "service_status": status, "bikes_available": bikes, "docks_available": docks,
                       "source_updated_at": at, "city": "ignored"})


class Feed:
    """A folder that a file stream reads; each `send` becomes one file."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        (root / "in").mkdir()

    def send(self, *lines):
        (self.root / "in" / f"{self.n:04}.ndjson").write_text("\n".join(lines) + "\n")
        self.n += 1

    def observations(self):
        return jobs.parse_observations(jobs.read_messages(
            self.spark, {"kind": "files", "path": str(self.root / "in"), "files_per_trigger": "1"}))

    def windows(self):
        table = jobs.window_table(self.spark, str(self.root / "stats"))
        jobs.start_sink(jobs.window_stats(jobs.dedupe_stream(self.observations())), "window_stats",
                        jobs.upsert_sink(table), str(self.root / "cp"), None).awaitTermination()
        return {(r["station_uid"], int((r["window_start"] - T0).total_seconds() // 60)): r for r in table.read().collect()}

    def events(self, kind):
        table = jobs.event_table(self.spark, str(self.root / "events"))
        if kind == "stateful":
            df, sink = status_events(self.observations()), jobs.insert_sink(table)
        else:
            df, sink = self.observations(), jobs.status_sink(table, str(self.root / "state"))
        jobs.start_sink(df, "status_events", sink, str(self.root / "cp"), None).awaitTermination()
        return seen(table.read())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_windows_close_once_and_late_rows_are_dropped(feed):
    feed.send(message("A", 1, 0, 10), message("A", 1, 0, 10), message("A", 20, 4, 6), message("A", 25, 4, 6, status=0),
              "not json", message("A", 3, None, 1))
    feed.send(message("A", 50, 3, 7))   # watermark reaches 40 minutes: the first window closes
    feed.send(message("A", 55, 3, 7))
    got = feed.windows()
    first = got[("A", 0)]
    assert (first["observations"], first["avg_bikes_available"], first["empty_observations"]) == (2, 2.0, 1)
    assert ("A", 30) not in got  # still open
    feed.send(message("A", 2, 9, 1))    # far behind the watermark
    feed.send(message("A", 200, 1, 9))
    feed.send(message("A", 201, 1, 9))
    got = feed.windows()                # a restart from the checkpoint
    assert got[("A", 0)]["observations"] == 2 and got[("A", 30)]["observations"] == 2


@pytest.mark.parametrize("kind", ["stateful", "tables"])
def test_stream_equals_batch_and_survives_restarts(feed, observations, kind):
    rows = dedupe(random_rows(4, 150))
    want = seen(status_events_batch(observations(rows), ARRIVAL))
    for lo in (0, 100, 200):
        part = [r for r in rows if lo <= r[1] < lo + 100]
        feed.send(*[message(*r) for r in part], *[message(*r) for r in part[:5]])
        if lo != 100:
            got = feed.events(kind)     # one run for the first file, one for the other two
    assert got == want


def test_replayed_batch_changes_no_table(spark, feed, observations, tmp_path):
    table = jobs.event_table(spark, str(tmp_path / "e"))
    sink = jobs.status_sink(table, str(tmp_path / "s"))
    batch = observations([("A", 0, 0, 5, 1), ("A", 3, 2, 3, 1)])
    sink(batch, 0)
    once = seen(table.read())
    sink(batch, 0)
    assert seen(table.read()) == once and len(once) == 2
    sink(observations([("A", 3, 2, 3, 1), ("A", 5, 0, 5, 1)]), 1)
    assert len(seen(table.read())) == 3


def test_both_queries_from_one_source_and_progress(spark, feed):
    feed.send(message("A", 1, 0, 10), message("B", 2, 5, 5))
    feed.send(message("A", 90, 3, 7))
    feed.send(message("A", 91, 3, 7))
    log = ProgressLog(spark, str(feed.root / "progress"))
    spark.streams.addListener(log)
    try:
        queries = jobs.run_stream(spark, feed.observations(), str(feed.root / "job"), trigger_seconds=None)
        jobs.wait_all(queries)
        for query in queries:
            log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    samples = read_samples(spark, str(feed.root / "progress"))
    read = samples.where("metric = 'input_rows'").groupBy("series").agg(F.sum("value").alias("n"))
    assert {r["series"]: r["n"] for r in read.collect()} == {"window_stats": 4.0, "status_events": 4.0}
    assert jobs.window_table(spark, str(feed.root / "job/window_stats")).read().count() == 2
    assert jobs.event_table(spark, str(feed.root / "job/status_events")).read().count() == 2
    assert {"batch_duration_seconds", "watermark_timestamp"} <= {r["metric"] for r in samples.collect()}
    sinks = spark.read.parquet(str(feed.root / "job/written")).where("metric = 'written_rows'").groupBy("series").agg(F.sum("value").alias("n"))
    assert {r["series"]: r["n"] for r in sinks.collect()} == {"window_stats": 2.0, "status_events": 2.0}


def test_a_failing_sink_stops_its_query(feed):
    feed.send(message("A", 1, 0, 10))

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")
    query = jobs.start_sink(feed.observations(), "broken", fail, str(feed.root / "cp"), None)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()


def test_a_batch_is_evaluated_once(spark, feed, observations):
    """Sinks read their batch several times; what made it runs once."""
    runs = spark.sparkContext.accumulator(0)

    def passed(chunks):
        for chunk in chunks:
            runs.add(len(chunk))
            yield chunk
    batch = observations([("A", 0, 0, 5, 1), ("A", 3, 2, 3, 1)])
    counted = batch.mapInPandas(passed, batch.schema)
    jobs.status_sink(jobs.event_table(spark, str(feed.root / "e")), str(feed.root / "s"))(counted, 0)
    assert runs.value == 2


def test_change_feed_delivers_again_after_a_crash_and_loses_nothing(spark, feed):
    feed.send(message("A", 1, 0, 10), message("B", 2, 5, 5))
    feed.send(message("A", 1, 0, 10), message("A", 5, 1, 9), message("B", 1, 4, 6), message("C", 0, 1, 1))
    feed.send(message("A", 5, 1, 9), message("C", 9, 2, 0))
    sent, down = [], {1}

    def deliver(fresh, number):
        sent.append((number, sorted((r["station_uid"], r["bikes_available"]) for r in fresh.collect())))
        if number in down:  # delivered, but the job dies before its marks are written
            down.discard(number)
            raise RuntimeError("gone")

    def run():
        sink = jobs.change_sink(deliver, str(feed.root / "marks"))
        jobs.start_sink(feed.observations(), "feed", sink, str(feed.root / "cp"), None).awaitTermination()
    with pytest.raises(Exception, match="gone"):
        run()
    run()
    again = (1, [("A", 1), ("C", 1)])
    assert sent[:4] == [(0, [("A", 0), ("B", 5)]), again, again, (2, [("C", 2)])] and not any(rows for _, rows in sent[4:])


def test_an_idle_query_reports_that_it_lives(spark, feed):
    """With nothing to read, the newest sample of a query still moves on."""
    feed.send(message("A", 1, 0, 10))
    before = spark.conf.get("spark.sql.streaming.noDataProgressEventInterval")
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "200")
    log = ProgressLog(spark, str(feed.root / "progress"))
    spark.streams.addListener(log)
    query = None
    try:
        query = jobs.start_sink(feed.observations(), "idle_feed", lambda batch, number: None, str(feed.root / "cp"), 0)
        until = time.monotonic() + 60
        while time.monotonic() < until:
            time.sleep(1)
            found = read_samples(spark, str(feed.root / "progress")).where("series = 'idle_feed'") if (feed.root / "progress").exists() else None
            if found is not None and found.where("metric = 'idle'").count() >= 2:
                break
        last = found.where("metric = 'last_progress_timestamp'").agg(F.max("value")).first()[0]
        work = found.where("metric = 'input_rows'").agg(F.unix_micros(F.max("ts")) / 1e6).first()[0]
        assert last > work and found.where("metric = 'idle'").count() >= 2
    finally:
        if query:
            query.stop()
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", before)


def test_late_rows_are_counted(spark, feed):
    feed.send(message("A", 100, 1, 9))
    feed.send(message("A", 101, 1, 9))  # a row is judged by the watermark of the batch before
    feed.send(message("A", 1, 1, 9), message("B", 2, 1, 9), message("A", 95, 1, 9))
    feed.send(message("B", 3, 1, 9))
    log = ProgressLog(spark, str(feed.root / "progress"))
    spark.streams.addListener(log)
    try:
        query = jobs.start_sink(jobs.window_stats(jobs.dedupe_stream(feed.observations())), "late", lambda batch, number: batch.count(), str(feed.root / "cp"), None)
        query.awaitTermination()
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    late = read_samples(spark, str(feed.root / "progress")).where("metric = 'late_rows'")
    assert late.agg(F.sum("value")).first()[0] == 3.0


class Shelf:
    """A state handle in memory that knows the most it held of one kind."""

    def __init__(self):
        self.values, self.most = {}, 0

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def exists(self):
        return "station" in self.values

    def get(self):
        return self.values["station"]

    def update(self, value):
        self.values["station"] = value

    def updateValue(self, key, value):
        self.values[key] = value

    def getValue(self, key):
        self.most = max(self.most, len(self.values[key][0]))
        return self.values[key]

    def removeKey(self, key):
        del self.values[key]


@pytest.mark.parametrize("step_us", [1, 50_000_000])
def test_a_burst_of_one_station_is_worked_off_by_slices(monkeypatch, step_us):
    """In any order and in many chunks: the same events as in one piece, and no more than a slice of the rows at a time."""
    import random

    import numpy as np
    import pandas as pd

    from kerbflow.streaming import stateful
    r, n = random.Random(6), 4000
    at = [1_900_000_000_000_000 + step_us * r.randrange(3 * n) for _ in range(n)]
    frame = pd.DataFrame({"source_updated_at": np.array(at, "datetime64[us]"), "service_status": [r.choice([1, 1, 1, 0, None]) for _ in at],
                          "bikes_available": [r.choice([0, 3, 9]) for _ in at], "docks_available": [r.choice([0, 4]) for _ in at]})
    want, last = stateful.changes(stateful._compact(frame), None)
    monkeypatch.setattr(stateful, "HELD", 200)
    seen = []
    whole = stateful.changes
    monkeypatch.setattr(stateful, "changes", lambda rows, state: (seen.append(len(rows)), whole(rows, state))[1])
    shelf, detector = Shelf(), stateful.Detector()
    detector.init(shelf)
    found = list(detector.handleInputRows(("A",), iter([frame.iloc[i:i + 150] for i in range(0, n, 150)]), None))
    got = pd.concat(found)
    assert (got.pop("station_uid") == "A").all()
    pd.testing.assert_frame_equal(got.reset_index(drop=True), want)
    assert shelf.values == {"station": last}
    span = max(at) - min(at)
    assert max(seen) <= (n if span < stateful.SLICE_US else 2 * n * stateful.SLICE_US / span + 50)


def test_window_state_is_kept_on_disk(feed):
    """Deduplication and windows hold their state outside the heap."""
    feed.spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    feed.send(message("A", 1, 0, 10))
    table = jobs.window_table(feed.spark, str(feed.root / "stats"))
    query = jobs.start_sink(jobs.window_stats(jobs.dedupe_stream(feed.observations())), "window_stats",
                            jobs.upsert_sink(table), str(feed.root / "cp"), None)
    query.awaitTermination()
    assert all(any("rocksdb" in name for name in state["customMetrics"]) for state in query.recentProgress[0]["stateOperators"])


def test_a_message_is_parsed_once(spark):
    """Filters on parsed columns would otherwise move below and parse the message again, each of them, unreadable ones included."""
    line = '{"station_uid": "a", "source_updated_at": "2027-03-01T04:00:00Z", "service_status": 1, "bikes_available": 1, "docks_available": 2}'
    messages = spark.createDataFrame([(x,) for x in [line, None, "", "{", "null", "[]", '{"station_uid": "a"}', line]], "value string")
    found = jobs.window_stats(jobs.parse_observations(messages))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [(r["station_uid"], r["observations"], r["avg_docks_available"]) for r in found.collect()] == [("a", 2, 2.0)]
