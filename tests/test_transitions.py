import random

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.status import classify
from kerbflow.operators.transitions import advance_status, status_events_batch
from kerbflow.session import store
from kerbflow.streaming.jobs import STATE_TABLE
from tests.conftest import T0

ARRIVAL = ["bikes_available", "docks_available", "service_status"]


def seen(events):
    return sorted((r["station_uid"], int((r["changed_at"] - T0).total_seconds() // 60), r["status"], r["previous_status"],
                   r["previous_duration_seconds"]) for r in events.collect())


def by_hand(rows):
    """The rule, one row at a time."""
    out, state, last = [], {}, {}
    for uid, m, b, d, s in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3], -1 if r[4] is None else r[4])):
        if uid in last and m <= last[uid]:
            continue
        last[uid] = m
        status = "out_of_service" if s != 1 else "empty" if b == 0 else "full" if d == 0 else "normal"
        before = state.get(uid)
        if before and before[0] == status:
            continue
        if before or status != "normal":
            out.append((uid, m, status, before[0] if before else None, (m - before[1]) * 60 if before else None))
        state[uid] = (status, m)
    return sorted(out)


def test_status_of_every_small_count(spark):
    """Over all counts up to three and all codes: what the row loop below takes as its rule."""
    codes = [None, -1, 0, 1, 2, 7]
    rows = [(b, d, c) for b in range(4) for d in range(4) for c in codes]
    got = spark.createDataFrame(rows, "b int, d int, s int").select("*", classify(F.col("b"), F.col("d"), F.col("s")).alias("x")).collect()
    for r in got:
        want = [status for _, _, status, *_ in by_hand([("z", 0, r["b"], r["d"], r["s"])])] or ["normal"]
        assert r["x"] == want[0]


@pytest.mark.parametrize("seed", range(3))
def test_state_after_each_batch_is_that_of_all_rows_so_far(spark, observations, seed):
    """Batches in time order, each with rows of the ones before mixed in again."""
    rows, state, got = dedupe(random_rows(20 + seed, 120)), spark.createDataFrame([], STATE_TABLE), []
    for lo in range(0, 300, 150):
        batch = [r for r in rows if r[1] < lo + 150 and (r[1] >= lo or r[1] % 3 == 0)]
        events, after = advance_status(state, observations(batch), ARRIVAL)
        got += seen(events)
        state = store(after, "state")
        newest = {}
        for r in rows:
            if r[1] < lo + 150:
                newest[r[0]] = max(newest.get(r[0], -1), r[1])
        assert {r["station_uid"]: r["last_seen_us"] for r in state.collect()} == {
            uid: int((T0 - T0.replace(year=1970, month=1, day=1, hour=0)).total_seconds() + m * 60) * 10**6 for uid, m in newest.items()}
    assert sorted(got) == by_hand(rows)


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    # Station A holds most rows.
    return [(rnd.choice("AAAAAABC"), rnd.randrange(300), *(lambda b: (b, 4 - b))(rnd.randrange(5)), rnd.choice([1, 1, 1, 0, None]))
            for _ in range(n)]


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 50, 7])
def test_batch_equals_row_loop_for_any_slice_size(observations, rows_per_slice):
    rows = random_rows(1)
    got = seen(status_events_batch(observations(rows), ARRIVAL, rows_per_slice))
    assert [e[:4] for e in got] == [e[:4] for e in by_hand(dedupe(rows))]
    assert got == by_hand(dedupe(rows))


def dedupe(rows):
    """The first copy of an instant in arrival order, nulls last, as Spark ranks it."""
    best = {}
    for r in rows:
        k = (r[0], r[1])
        rank = (r[2], r[3], r[4] is None, r[4] or 0)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, r)
    return [r for _, r in best.values()]


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 20])
def test_batches_equal_whole_history_on_ordered_input(spark, observations, rows_per_slice):
    rows = dedupe(random_rows(2))
    state, got = spark.createDataFrame([], STATE_TABLE), []
    for lo in range(0, 300, 100):
        events, state = advance_status(state, observations([r for r in rows if lo <= r[1] < lo + 100]), ARRIVAL, rows_per_slice)
        got += seen(events)
        state = store(state, "state")
    assert sorted(got) == by_hand(rows)


def test_durations_are_whole_seconds(spark, observations):
    rows = observations([("A", 0, 1, 1, 1), ("A", 10, 0, 2, 1)])
    late = rows.withColumn("source_updated_at", F.when(F.col("bikes_available") == 0, F.col("source_updated_at") - F.expr(
        "INTERVAL 0.5 SECOND")).otherwise(F.col("source_updated_at")))
    assert status_events_batch(late, ARRIVAL).first()["previous_duration_seconds"] == 599
