from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from kerbflow.operators.merge import (
    commit_seen, incremental_slice, insert_new, merge_incremental, select_changed, upsert,
)
from kerbflow.sources.tables import KeyedTable
from tests.conftest import T0

SCHEMA = "k string, at timestamp, v long"


def at(hours):
    return T0 + timedelta(hours=hours)


@pytest.fixture
def frame(spark):
    return lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema)


def test_upsert_replaces_and_inserts_newest(frame):
    target = frame([("a", at(0), 1), ("b", at(0), 2)])
    batch = frame([("b", at(1), 3), ("b", at(2), 4), ("c", at(1), 5)])
    out = upsert(target, batch, ["k"], order=["at"], stamp=("updated", F.lit(1)), evolve=True)
    assert {(r["k"], r["v"], r["updated"]) for r in out.collect()} == {("a", 1, None), ("b", 4, 1), ("c", 5, 1)}


def test_insert_new_leaves_stored_rows_alone(frame):
    out = insert_new(frame([("a", at(0), 1)]), frame([("a", at(1), 9), ("b", at(1), 2), ("b", at(2), 3)]), ["k"], order=["at"])
    assert {(r["k"], r["v"]) for r in out.collect()} == {("a", 1), ("b", 2)}


def test_empty_target_takes_the_whole_source(frame):
    source = frame([("a", at(0), 1), ("b", at(-900), 2)])
    part = incremental_slice(source, source.limit(0), "at", "at", timedelta(hours=3), timedelta(days=2), T0)
    assert part.count() == 2


@pytest.mark.parametrize("mode,kept", [("keep", 1), ("update", 2)])
def test_merge_keep_or_update(frame, mode, kept):
    out = merge_incremental(frame([("a", at(0), 1)]), frame([("a", at(0), 2), ("b", at(0), 3)]), ["k", "at"], "at", at(-1), mode)
    assert {(r["k"], r["v"]) for r in out.collect()} == {("a", kept), ("b", 3)}


def test_change_feed_and_marks(frame):
    seen = frame([("a", at(1), 0)])
    batch = frame([("a", at(1), 1), ("a", at(2), 2), ("b", at(0), 3), ("b", at(0), 4), (None, at(5), 5), ("c", None, 6)])
    fresh = select_changed(batch, seen, "k", "at")
    assert sorted(r["v"] for r in fresh.collect()) == [2, 3, 4]  # a key twice in one batch goes out twice
    marks = commit_seen(seen, fresh.where("k = 'b'"), "k", "at")  # the delivery of `a` failed
    assert {(r["k"], r["at"]) for r in marks.collect()} == {("a", at(1)), ("b", at(0))}


@pytest.mark.parametrize("day_of", [None, "at"])
def test_replaying_a_batch_changes_nothing(spark, frame, tmp_path, day_of):
    table = KeyedTable(spark, str(tmp_path / "t"), frame([]).schema, ["k", "at"], day_of=day_of)
    assert table.read().count() == 0
    first, second = frame([("a", at(0), 1), ("b", at(30), 2)]), frame([("a", at(0), 9), ("c", at(60), 3)])
    for i, batch in enumerate([first, second, second]):
        table.upsert(batch)
    assert {(r["k"], r["v"]) for r in table.read().collect()} == {("a", 9), ("b", 2), ("c", 3)}


def test_untouched_partitions_are_not_rewritten(spark, frame, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame([]).schema, ["k", "at"], day_of="at")
    table.upsert(frame([("a", at(0), 1), ("b", at(48), 2)]))
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("part_day=2027-03-01/*.parquet")}
    table.upsert(frame([("b", at(48), 3)]))
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("part_day=2027-03-01/*.parquet")} == before


@pytest.mark.parametrize("gone", ["none", "old", "old and one staged"])
def test_a_job_that_dies_between_staging_and_table_loses_nothing(spark, frame, tmp_path, monkeypatch, gone):
    table = KeyedTable(spark, str(tmp_path / "t"), frame([]).schema, ["k", "at"], day_of="at")
    table.upsert(frame([("a", at(0), 1), ("b", at(1), 2), ("c", at(48), 3)]))
    old = list((tmp_path / "t").glob("part_day=2027-03-01/*.parquet"))
    whole = KeyedTable._recover

    def die(self):
        if (tmp_path / "t.staged").exists():
            raise RuntimeError("gone")
        whole(self)
    monkeypatch.setattr(KeyedTable, "_recover", die)
    with pytest.raises(RuntimeError):
        table.upsert(frame([("a", at(0), 9), ("d", at(48), 4)]))
    monkeypatch.setattr(KeyedTable, "_recover", whole)
    if gone != "none":  # as if the recovery itself had died after its first steps
        for p in old:
            p.unlink()
    if gone == "old and one staged":
        staged = sorted((tmp_path / "t.staging").glob("part_day=*/*.parquet"))[0]
        staged.rename(tmp_path / "t" / staged.parent.name / staged.name)
    assert sorted((r["k"], r["v"]) for r in table.read().collect()) == [("a", 9), ("b", 2), ("c", 3), ("d", 4)]
    assert not list(tmp_path.glob("t.stag*"))


def test_bytes_written_follow_the_batch(spark, tmp_path):
    """Of many files an upsert replaces those that hold a key of its batch, and writes each row of them once."""
    rows = spark.range(20_000).selectExpr("format_string('k%06d', id) AS k", "id AS v")
    table = KeyedTable(spark, str(tmp_path / "t"), rows.schema, ["k"], buckets=4, rows_per_file=500)
    table.upsert(rows)
    files = lambda: {f"{p.parent.name}/{p.name}": p.stat().st_size for p in (tmp_path / "t").glob("part_bucket=*/*.parquet")}
    before = files()
    assert len(before) >= 40
    for n in (1, 5):
        table.upsert(rows.where(f"v % {20_000 // n} = 7").withColumn("v", -F.col("v")))
        after = files()
        new = {name: size for name, size in after.items() if name not in before}
        assert len(before) - len(set(before) & set(after)) <= n and sum(new.values()) <= 1.5 * n * max(before.values())
        before = after
    assert table.read().count() == 20_000 and table.read().where("v < 0").count() == 5


def test_a_schema_version_that_was_not_finished_does_not_count(spark, frame, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), frame([]).schema, ["k", "at"], day_of="at")
    table.insert_new(frame([("a", at(0), 1)]).withColumn("one", F.lit("x")))
    whole = KeyedTable._write_file

    def die(self, path, content):
        whole(self, path + ".part", content[:20])  # what a crash leaves: an unfinished file under another name
        raise RuntimeError("gone")
    monkeypatch.setattr(KeyedTable, "_write_file", die)
    with pytest.raises(RuntimeError):
        table.insert_new(frame([("b", at(0), 2)]).withColumn("two", F.lit("y")))
    monkeypatch.setattr(KeyedTable, "_write_file", whole)
    assert table.read().columns == ["k", "at", "v", "one"]
    table.insert_new(frame([("b", at(0), 2)]).withColumn("two", F.lit("y")))
    assert sorted((r["k"], r["one"], r["two"]) for r in table.read().collect()) == [("a", "x", None), ("b", None, "y")]


def test_new_columns_are_kept_and_inserts_append(spark, frame, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame([]).schema, ["k", "at"], day_of="at")
    table.insert_new(frame([("a", at(0), 1)]))
    kept = {p.name for p in (tmp_path / "t").glob("part_day=*/*.parquet")}
    wide = frame([("a", at(0), 7), ("b", at(0), 2)]).withColumn("extra", F.lit("x"))
    for _ in range(2):
        table.insert_new(wide)
    assert sorted((r["k"], r["v"], r["extra"]) for r in table.read().collect()) == [("a", 1, None), ("b", 2, "x")]
    assert kept <= {p.name for p in (tmp_path / "t").glob("part_day=*/*.parquet")}
    table.upsert(frame([("b", at(0), 5)]))
    assert sorted((r["k"], r["v"], r["extra"]) for r in table.read().collect()) == [("a", 1, None), ("b", 5, None)]


def test_a_table_that_cannot_be_read_is_no_empty_table(spark, frame, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame([]).schema, ["k", "at"], day_of="at")
    (tmp_path / "t" / "part_day=2027-03-01").mkdir(parents=True)
    (tmp_path / "t" / "part_day=2027-03-01" / "part-0.parquet").write_text("broken")
    with pytest.raises(Exception):
        table.upsert(frame([("a", at(0), 1)]))
