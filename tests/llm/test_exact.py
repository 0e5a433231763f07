"""Exact duplicates by a stream with state, against a plain grouping."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kerbflow.llm import exact

SCHEMA = "doc_id long, text string, digest string, entry int, content string, `a.b` int, keep string"
ROWS = [(1, "a b"), (2, "ab"), (3, "a  b\t"), (4, None), (5, ""), (6, " \n"), (7, "x" * 200_000), (8, "x" * 200_000 + " "), (9, "É"), (10, "é"),
        (11, "a b"), (None, "named"), (12, "named"), (None, "unnamed"), (None, "unnamed"), (13, "twice"), (13, "twice"), (14, "AB")]
MANY = [(100 + i, "common passage" if i % 3 == 0 else f"text {i // 2}") for i in range(240)]


def write(spark, rows, path, mode="append", files=1):
    frame = spark.createDataFrame([(i, t, "d", 1, "c", 2, "k") for i, t in rows], SCHEMA)
    frame.repartition(files).write.mode(mode).parquet(path)


def brute(rows):
    """The multiset of (id, keep_id, group_size, text_sha256), and kept rows by content."""
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), i is None, i or 0))
    out, kept = [], []
    for content, own in groups.items():
        best, sha = min(own), hashlib.sha256(content.encode()).hexdigest()
        name = None if best[1] else best[2]
        out += [(None if e[1] else e[2], name, len(own), sha) for e in own]
        kept.append((name, sha))
    return sorted(map(str, out)), sorted(map(str, kept))


def results(found):
    rows = found.collect()
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return (sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in rows),
            sorted(str((r.doc_id, r.text_sha256)) for r in rows if r.kept))


def stream(spark, path, per_batch=1000):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", per_batch).parquet(path)


@pytest.mark.parametrize("digest", [exact.sha256, lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(3)).cast("string").cast("binary")])
def test_equal_texts_whatever_the_digest(spark, tmp_path, digest):
    """A digest with three values lets contents clash; the whole contents decide then."""
    path, where = str(tmp_path / "docs"), str(tmp_path / "where")
    write(spark, ROWS + MANY, path, files=3)
    exact.observe(stream(spark, path), where, digest=digest)
    assert results(exact.duplicates(spark.read.parquet(path), where, digest=digest)) == brute(ROWS + MANY)


def test_state_goes_on_with_files_that_come_later(spark, tmp_path):
    """Several batches, a later run and a run without news give what one run over all files gives."""
    path, where = str(tmp_path / "docs"), str(tmp_path / "where")
    write(spark, ROWS + MANY[:100], path, files=4)
    exact.observe(stream(spark, path, per_batch=2), where)
    first = spark.read.parquet(f"{where}/changes").select("batch").distinct().count()
    assert first >= 2
    write(spark, MANY[100:], path, files=2)
    exact.observe(stream(spark, path), where)
    exact.observe(stream(spark, path), where)
    assert results(exact.duplicates(spark.read.parquet(path), where)) == brute(ROWS + MANY)
    later = spark.read.parquet(f"{where}/changes").where(F.col("batch") >= first)
    # The state alone knew the earlier copies: the later files were the only ones read.
    common = later.where("group_size > 40").agg(F.max("group_size")).first()[0]
    assert common == sum(t == "common passage" for _, t in MANY)
    state = spark.read.format("statestore").load(f"{where}/state")
    assert state.count() == len(brute(ROWS + MANY)[1])


def test_repeated_batch_changes_nothing(spark, tmp_path):
    path, where = str(tmp_path / "docs"), str(tmp_path / "where")
    write(spark, MANY, path)
    exact.observe(stream(spark, path), where)
    changes = spark.read.parquet(f"{where}/changes/batch=0")
    changes.limit(50).write.parquet(f"{where}/changes/batch=1")
    assert results(exact.duplicates(spark.read.parquet(path), where)) == brute(MANY)


def test_empty_table(spark, tmp_path):
    path, where = str(tmp_path / "docs"), str(tmp_path / "where")
    write(spark, [], path)
    exact.observe(stream(spark, path), where)
    assert exact.duplicates(spark.read.parquet(path), where).count() == 0


def test_main_path_has_no_python(spark, tmp_path):
    path, where = str(tmp_path / "docs"), str(tmp_path / "where")
    write(spark, MANY, path)
    exact.observe(stream(spark, path), where)
    plan = exact.duplicates(spark.read.parquet(path), where)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Nested" not in plan
