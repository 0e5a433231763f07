"""Published documents, name search, place labels and route replies on generated data."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbflow.operators.search import clean_places, match_stations
from kerbflow.plans.serving import iso_utc, snapshot, snapshot_payload
from kerbflow.sources.documents import EmptyResultError, parse_routes, parse_snapshot, read_snapshot, write_snapshot

ROW = ("station_uid string, station_name string, lat double, lng double, bikes_available long, docks_available long, "
       "is_in_service boolean, forecast_for timestamp, predicted_bikes_available double")
AT = datetime(2031, 11, 5, 23, 30)


def stations(n, seed):
    r, out = random.Random(seed), []
    for i in range(n):
        due, value = r.choice([(None, None), (AT + timedelta(minutes=r.randrange(1, 900)), r.randrange(400) / 16), (AT, None), (None, 1.5)])
        out.append((f"k{i:03}", r.choice([None, f"Net {r.choice('äöü')}{i}", f'Quo"te, {i}']), r.uniform(-80, 80), r.uniform(-170, 170),
                    r.randrange(30), r.randrange(30), r.random() < 0.8, due, value))
    return out


def at():
    return F.lit(AT.isoformat(sep=" ")).cast("timestamp")


def half_up(x, digits):
    import math
    return math.floor(x * 10**digits + 0.5) / 10**digits


def test_document_holds_each_station_once_and_reads_back(spark, tmp_path):
    rows = stations(70, 1)
    path = str(tmp_path / "snapshot")
    write_snapshot(snapshot_payload(spark.createDataFrame(rows, ROW).repartition(5), "Net "), iso_utc(at()), path)
    newest = max(p for p in (tmp_path / "snapshot").iterdir() if p.name.startswith("version="))
    text = "".join(p.read_text(encoding="utf-8") for p in sorted(newest.glob("part-*"))).replace("\n", "")
    document = json.loads(text)
    assert document["generated_at"] == AT.strftime("%Y-%m-%dT%H:%M:%SZ") and [s["id"] for s in document["stations"]] == [r[0] for r in rows]
    for shown, (uid, name, lat, lng, bikes, docks, open_, due, value) in zip(document["stations"], rows):
        want = {"id": uid, "name": (name or "").removeprefix("Net "), "lat": half_up(lat, 5), "lng": half_up(lng, 5), "bikes": bikes, "docks": docks, "in_service": open_}
        if due and value is not None:
            want["forecast"] = {"at": due.strftime("%Y-%m-%dT%H:%M:%SZ"), "bikes": half_up(value, 1)}
        assert shown == want
    back = read_snapshot(spark, path)
    assert sorted(back.collect(), key=str) == sorted(parse_snapshot(spark.createDataFrame([(text,)], "value string")).collect(), key=str)


def test_a_new_version_replaces_the_old_one_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    frame = spark.createDataFrame(stations(9, 2), ROW)
    for n in (5, 9, 3):
        write_snapshot(snapshot_payload(frame.limit(n), ""), iso_utc(at()), path)
        assert read_snapshot(spark, path).count() == n
    with pytest.raises(EmptyResultError):
        write_snapshot(snapshot_payload(frame.limit(0), ""), iso_utc(at()), path)
    half = tmp_path / "snapshot" / "version=99999999999999999999"  # a writer that died has left no mark of success
    half.mkdir()
    (half / "part-00000.txt").write_text('{"generated_at":"x","stations":[\n')
    assert read_snapshot(spark, path).count() == 3


def test_only_current_placed_stations_with_a_status_are_shown(spark):
    r = random.Random(4)
    known = [(f"k{i}", f"n{i}", r.choice([None, 1.0]), r.choice([None, 2.0, 2.0]), r.random() < 0.7) for i in range(60)]
    status = [(f"k{i}", 1, 2, r.choice([None, 0, 1, 2]), AT) for i in range(0, 80, 2)]
    got = snapshot(spark.createDataFrame(known, "station_uid string, station_name string, lat double, lng double, is_current boolean"),
                   spark.createDataFrame(status, "station_uid string, bikes_available long, docks_available long, service_status long, source_updated_at timestamp")).collect()
    seen = {s[0]: s[3] == 1 for s in status}
    assert {x["station_uid"]: x["is_in_service"] for x in got} == {k[0]: seen[k[0]] for k in known if k[4] and k[2] and k[3] and k[0] in seen}
    assert all(x["forecast_for"] is None for x in got)


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_search_equals_a_scan_of_all_names(spark, limit):
    r = random.Random(6)
    names = [(f"{i:03}", "".join(r.choice("abAB 公園") for _ in range(r.randrange(1, 9)))) for i in range(120)]
    asked = [(i, r.choice(["", " "]) + "".join(r.choice("abA公園") for _ in range(r.randrange(4))) + r.choice(["", "  "])) for i in range(25)]
    want = {}
    for q, text in asked:
        key = text.strip().lower()
        hits = sorted((n.lower().find(key), len(n), uid) for uid, n in names if key and key in n.lower())
        if hits:
            want[q] = [uid for *_, uid in hits[:limit]]
    found = match_stations(spark.createDataFrame(asked, "q int, query string"),
                           spark.createDataFrame(names, "station_uid string, station_name string"), limit=limit)
    got = {}
    for row in found.orderBy("q", "match_rank").collect():
        got.setdefault(row["q"], []).append(row["station_uid"])
    assert got == want


def test_place_labels_and_coordinates(spark):
    r = random.Random(7)
    places = []
    for _ in range(40):
        parts = [r.choice(["Ufer", "Tor 3", "80331", "Land", "Nord", ""]) for _ in range(r.randrange(6))]
        places.append((r.choice([None, "", "Ufer", "Hof"]), r.choice([None, ", ".join(parts), ",".join(parts)]), str(r.uniform(-90, 90)), r.choice(["7.5", "east", None])))
    got = clean_places(spark.createDataFrame(places, "name string, display_name string, lat string, lon string"), "Land", "?", "/").collect()
    for row, (name, shown, lat, lon) in zip(got, places):
        parts = [p.strip() for p in (shown or "").split(",") if p.strip()]
        short = name or (parts[0] if parts else "?")
        detail = [p for p in parts if p not in (short, "Land") and not p.isdigit()][:3]
        assert (row["name"], row["detail"], row["lat"], row["lon"]) == (short, "/".join(detail), float(lat), 7.5 if lon == "7.5" else None)


def test_routes_turn_pairs_around_and_drop_failures(spark):
    r = random.Random(8)
    replies, want = [], {}
    for i in range(20):
        line = [[r.uniform(5, 15), r.uniform(45, 55)] for _ in range(r.randrange(2, 6))]
        body = {"code": r.choice(["Ok", "Ok", "NoRoute"]), "routes": r.choice([[], [{"duration": 30.0 * i, "distance": 10.0 * i, "geometry": {"coordinates": line}}]])}
        replies.append((f"p{i}", 50.0, 10.0, 50.1, 10.1, json.dumps(body)))
        if body["code"] == "Ok" and body["routes"]:
            want[f"p{i}"] = (i / 2, 10.0 * i, [[b, a] for a, b in line])
    replies.append(("broken", 50.0, 10.0, 50.1, 10.1, "{"))
    legs = parse_routes(spark.createDataFrame(replies, "profile string, from_lat double, from_lng double, to_lat double, to_lng double, body string")).collect()
    assert {x["profile"]: (x["minutes"], x["meters"], x["path"]) for x in legs} == want
