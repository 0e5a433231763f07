"""Landing and normalising of generated records, against the same rules in plain Python."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.convert import display_name, to_int
from kerbflow.schemas import (
    AVAILABILITY_FIELDS, AVAILABILITY_REQUIRED, RAW_AVAILABILITY, RAW_STATION, STAGED_AVAILABILITY, STATION_FIELDS,
)
from kerbflow.sources import landing
from kerbflow.sources.normalize import SchemaError, normalize, normalize_records, read_records, station_rows

LOADED = datetime(2031, 6, 30, 15, 59, 59)
NUMBERS = {"ServiceStatus": "service_status", "ServiceType": "service_type", "AvailableRentBikes": "bikes_available",
           "AvailableReturnBikes": "docks_available"}


def whole(value):
    """What the rules make of a number or a text."""
    try:
        number = float(value)
    except (TypeError, ValueError):
        return None
    return int(number) if number == int(number) else None


def generated(n, seed):
    r, out = random.Random(seed), []
    for i in range(n):
        record = {"StationUID": r.choice([f"u{i}", f"u{i}", f"u{i}", None]), "StationID": str(i)}
        for field in NUMBERS:
            if r.random() < 0.9:
                record[field] = r.choice([r.randrange(40), str(r.randrange(40)), f" {r.randrange(9)}", r.random() + 0.1, "n/a", "", None, 3.0])
        if r.random() < 0.5:
            record["AvailableRentBikesDetail"] = {"GeneralBikes": r.randrange(5), "ElectricBikes": str(r.randrange(5))}
        at = datetime(2031, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=r.randrange(10**7))
        zone = timezone(timedelta(hours=r.choice([-5, 0, 8])))
        record["SrcUpdateTime"] = r.choice([at.astimezone(zone).isoformat(), at.astimezone(zone).isoformat(), "yesterday"])
        out.append(record)
    return out


@pytest.fixture
def records():
    return generated(60, 12)


@pytest.fixture
def raw(spark, records, tmp_path):
    for k in range(3):
        folder = tmp_path / "raw" / f"part{k}"
        folder.mkdir(parents=True)
        (folder / "x.json").write_text(json.dumps(records[k::3], ensure_ascii=False), encoding="utf-8")
    return landing.read_raw(spark, str(tmp_path / "raw"), RAW_AVAILABILITY)


def test_every_record_with_a_key_is_typed_by_the_rules(raw, records):
    rows = {r["station_id"]: r for r in normalize(raw, AVAILABILITY_FIELDS, "K", LOADED, AVAILABILITY_REQUIRED).collect()}
    assert set(rows) == {r["StationID"] for r in records if r["StationUID"]}
    for record in records:
        if not record["StationUID"]:
            continue
        row = rows[record["StationID"]]
        assert {name: row[name] for name in NUMBERS.values()} == {name: whole(record.get(field)) for field, name in NUMBERS.items()}
        assert row["ebikes_available"] == whole(record.get("AvailableRentBikesDetail", {}).get("ElectricBikes"))
        text = record["SrcUpdateTime"]
        want = None if text == "yesterday" else datetime.fromisoformat(text).astimezone(timezone.utc).replace(tzinfo=None)
        assert row["source_updated_at"] == want and (row["ingested_at"], row["city"]) == (LOADED, "K")


def test_staged_columns_follow_the_schema(raw):
    staged = normalize(raw, AVAILABILITY_FIELDS, "K", LOADED)
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in STAGED_AVAILABILITY]


@pytest.mark.parametrize("lost", AVAILABILITY_REQUIRED)
def test_a_batch_without_a_required_field_fails(spark, records, lost):
    bare = [{k: v for k, v in r.items() if k != lost} for r in records]
    frame = spark.createDataFrame([(json.dumps(r),) for r in bare], "j string").select(F.from_json("j", RAW_AVAILABILITY).alias("r")).select("r.*")
    with pytest.raises(SchemaError, match=lost):
        normalize(frame, AVAILABILITY_FIELDS, "K", LOADED, AVAILABILITY_REQUIRED)
    assert normalize(frame.limit(0), AVAILABILITY_FIELDS, "K", LOADED, AVAILABILITY_REQUIRED).count() == 0


@pytest.mark.parametrize("lost", AVAILABILITY_REQUIRED)
def test_a_field_that_is_null_everywhere_is_there_and_one_that_is_absent_is_not(spark, records, tmp_path, lost):
    """The records as they came decide, two files of them: typed rows could not tell the two cases apart."""
    def at(name, rows):
        (tmp_path / name).mkdir()
        for i in range(2):
            (tmp_path / name / f"{i}.json").write_text(json.dumps(rows[i::2], indent=1))
        return read_records(spark, str(tmp_path / name))
    nulled = at("null", [{**r, lost: None} for r in records])
    assert normalize_records(nulled, AVAILABILITY_FIELDS, "K", LOADED, AVAILABILITY_REQUIRED).count() == (0 if lost == "StationUID" else sum(bool(r["StationUID"]) for r in records))
    absent = at("absent", [{k: v for k, v in r.items() if k != lost} for r in records])
    with pytest.raises(SchemaError, match=lost):
        normalize_records(absent, AVAILABILITY_FIELDS, "K", LOADED, AVAILABILITY_REQUIRED)
    assert normalize_records(at("empty", []), AVAILABILITY_FIELDS, "K", LOADED, AVAILABILITY_REQUIRED).count() == 0


def test_typed_records_are_those_of_the_schema(spark, records, raw, tmp_path):
    whole = normalize_records(read_records(spark, str(tmp_path / "raw")), AVAILABILITY_FIELDS, "K", LOADED)
    want = normalize(raw, AVAILABILITY_FIELDS, "K", LOADED)
    assert whole.schema == want.schema and sorted(map(str, whole.collect())) == sorted(map(str, want.collect()))


def test_whole_numbers_keep_all_digits(spark):
    big = [str(2**53 + 1), str(-(2**63)), str(2**63 - 1)]
    texts = [*big, str(2**63), "1e3", "-0", "+5", "1.50", "0x1f", "NaN", "Infinity", "", " ", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(to_int(F.col("t"))).collect()]
    assert got == [int(b) for b in big] + [None, 1000, 0, 5, None, None, None, None, None, None, None]


def test_stations_keep_their_place_and_lose_the_brand(spark):
    r = random.Random(3)
    stations = [{"StationUID": f"s{i}" if i % 7 else None, "StationName": {"Zh_tw": r.choice(["Net+ Platz", "Platz Net+", None])},
                 "BikesCapacity": i, "StationPosition": {"PositionLon": r.uniform(-180, 180), "PositionLat": r.uniform(-90, 90)}} for i in range(30)]
    body = spark.createDataFrame([(json.dumps(s),) for s in stations], "j string")
    flat = normalize(body.select(F.from_json("j", RAW_STATION).alias("r")).select("r.*"), STATION_FIELDS, "K", LOADED)
    got = {x["station_uid"]: (x["station_name"], x["lat"], x["lng"], x["capacity"]) for x in station_rows(flat, "Net+ ").collect()}
    assert got == {s["StationUID"]: ((s["StationName"]["Zh_tw"] or "").removeprefix("Net+ "), s["StationPosition"]["PositionLat"],
                                     s["StationPosition"]["PositionLon"], s["BikesCapacity"]) for s in stations if s["StationUID"]}
    assert spark.range(1).select(display_name(F.lit("a.b"), "a+")).first()[0] == "a.b"


def test_staged_lines_hold_every_column_in_utc(raw):
    staged = normalize(raw, AVAILABILITY_FIELDS, "K", LOADED)
    for line in landing.to_ndjson(staged).collect():
        row = json.loads(line["value"])
        assert list(row) == staged.columns
        if row["source_updated_at"]:
            assert datetime.strptime(row["source_updated_at"], "%Y-%m-%dT%H:%M:%S.%fZ")


@pytest.mark.parametrize("zone,hours", [("Asia/Taipei", 8), ("UTC", 0), ("America/Lima", -5)])
def test_landed_loads_lie_under_local_time_and_stamp(spark, raw, tmp_path, zone, hours):
    loads = [LOADED + timedelta(hours=7 * i) for i in range(3)]
    for at in loads:
        landing.land(normalize(raw, AVAILABILITY_FIELDS, "K", at), str(tmp_path), "seen", zone, at)
    for at in loads:
        local = at + timedelta(hours=hours)
        where = f"city=K/dt={local:%Y-%m-%d}/hour={local:%H}/load={at:%Y%m%dT%H%M%SZ}"
        assert list((tmp_path / "staged/seen" / where).glob("*.txt"))
    back = landing.read_staged(spark, str(tmp_path / "staged/seen"), STAGED_AVAILABILITY)
    staged = normalize(raw, AVAILABILITY_FIELDS, "K", loads[-1])
    newest = landing.newest_batch(back)
    assert sorted(newest.select(*staged.columns).collect(), key=str) == sorted(staged.collect(), key=str)
    assert "PartitionFilters" in newest._jdf.queryExecution().executedPlan().toString()
    days = {(at + timedelta(hours=hours)).date() for at in loads}
    for day in days:
        noon = datetime(day.year, day.month, day.day, 12) - timedelta(hours=hours)
        got = {r["dt"] for r in landing.recent_days(back, noon, zone, days=1).select(F.col("dt").cast("string").alias("dt")).distinct().collect()}
        assert got == {str(day)}


def test_raw_responses_land_as_they_came(spark, tmp_path):
    bodies = spark.createDataFrame([("K", LOADED, '[{"a": 1}]'), ("L", LOADED, "[]")], "city string, ingested_at timestamp_ntz, body string")
    landing.land_raw(bodies, str(tmp_path), "seen", "UTC", LOADED)
    files = list(tmp_path.glob("raw/seen/city=K/dt=*/hour=*/load=20310630T155959Z/*.txt"))
    assert [f.read_text() for f in files] == ['[{"a": 1}]\n']


def test_nothing_landed_gives_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], STAGED_AVAILABILITY).withColumn("load", F.lit(""))
    assert landing.newest_batch(empty).count() == 0


def test_raw_table_reads_only_the_days_asked_for(spark, raw, tmp_path):
    path = str(tmp_path / "table")
    for day in (1, 2, 3):
        landing.append_raw(normalize(raw, AVAILABILITY_FIELDS, "K", datetime(2031, 3, day, 11, 45)), path)
    one = landing.read_raw_table(spark, path).count() // 3
    assert landing.read_raw_table(spark, path, datetime(2031, 3, 2)).count() == 2 * one
    assert landing.read_raw_table(spark, path, datetime(2031, 3, 2, 12)).count() == one
    plan = landing.read_raw_table(spark, path, datetime(2031, 3, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
