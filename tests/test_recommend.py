import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.geo import point_key
from kerbflow.functions.status import availability_level
from kerbflow.operators import recommend as rec
from kerbflow.operators.knn import knn

STATION = ("station_uid string, station_name string, lat double, lng double, bikes_available long, docks_available long, "
           "is_in_service boolean, forecast_for timestamp, predicted_bikes_available double")
NOW = datetime(2031, 4, 9, 7, 45)


def now():
    return F.lit(NOW.isoformat(sep=" ")).cast("timestamp")


def metres(a, b):
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))


def town(seed, n=40):
    """Stations strewn over some kilometres; some closed, empty or full, some with forecasts due, overdue or halved."""
    r, out = random.Random(seed), []
    for i in range(n):
        ahead = r.choice([None, None, -20, 5, 25, 90])
        out.append((f"q{i:02}", f"name {i}", -33.4 + r.uniform(-.02, .02), -70.6 + r.uniform(-.02, .02), r.choice([0, 1, 2, 9, 20]), r.choice([0, 1, 2, 9, 20]),
                    r.random() < 0.85, None if ahead is None else NOW + timedelta(minutes=ahead), None if ahead is None else r.uniform(-3, 40)))
    return out


def journeys(seed, n=25):
    r = random.Random(seed)
    spot = lambda: (-33.4 + r.uniform(-.025, .025), -70.6 + r.uniform(-.025, .025))
    return [(i, *spot(), *spot()) for i in range(n)]


def expected_bikes(station, minutes):
    bikes, docks, due, value = station[4], station[5], station[7], station[8]
    if due is None or value is None or due <= NOW:
        return float(bikes)
    share = min(1.0, max(0.0, minutes / ((due - NOW).total_seconds() / 60)))
    return min(max(bikes + (value - bikes) * share, 0.0), float(bikes + docks))


def known_legs(seed, trips, stations):
    """Looked-up times for some legs, in one direction only, some twice."""
    r, legs = random.Random(seed), []
    for trip in trips:
        for s in r.sample(stations, 12):
            a, b = r.choice([(trip[1:3], s[2:4]), (s[2:4], trip[3:5]), (s[2:4], r.choice(stations)[2:4])])
            legs += [(r.choice(["walk", "ride"]), *a, *b, r.uniform(1, 30), r.uniform(50, 5000))] * r.choice([1, 1, 2])
    return legs


def leg_key(a, b):
    return tuple(round(x, 5) for x in (*a, *b))


def ranked(trip, stations, legs):
    """The options of a trip, best first, by going through all pairs of the six nearest stations of both ends."""
    times = {}
    for profile, *points, minutes, length in legs:
        key = (profile, leg_key(points[:2], points[2:]))
        times[key] = min(times.get(key, (minutes, length)), (minutes, length))
    o, d = trip[1:3], trip[3:5]
    near = lambda p: sorted((s for s in stations if s[6]), key=lambda s: (round(metres(p, s[2:4]), 3), s[0]))[:6]

    def minutes(profile, a, b):
        return times[profile, leg_key(a, b)][0] if (profile, leg_key(a, b)) in times else metres(a, b) * 1.3 / (75 if profile == "walk" else 250)
    found = []
    for i, rent in enumerate(near(o)):
        first = minutes("walk", o, rent[2:4])
        bikes = expected_bikes(rent, first)
        for j, back in enumerate(near(d)):
            ride = minutes("ride", rent[2:4], back[2:4])
            docks = back[4] + back[5] - expected_bikes(back, first + ride)
            if rent is back or bikes < 1 or docks < 1:
                continue
            score = first + ride + minutes("walk", back[2:4], d) + 4 * (bikes < 3) + 4 * (docks < 3)
            found.append((math.floor(score * 1000 + .5), i, j, rent[0], back[0], round(score, 6)))
    return [(x[3], x[4], x[5]) for x in sorted(found)[:3]]


@pytest.mark.parametrize("seed,legs", [(1, False), (2, True), (3, True)])
def test_options_equal_a_walk_through_all_pairs(spark, seed, legs):
    stations, trips = town(seed), journeys(seed + 50)
    looked_up = known_legs(seed, trips, stations) if legs else []
    table = spark.createDataFrame(looked_up, "profile string, a double, b double, c double, d double, minutes double, meters double").select(
        "profile", point_key(F.col("a"), F.col("b")).alias("from_key"), point_key(F.col("c"), F.col("d")).alias("to_key"), "minutes", "meters") if legs else None
    frame = spark.createDataFrame(trips, "trip_id long, origin_lat double, origin_lng double, dest_lat double, dest_lng double")
    options = rec.recommend(frame, spark.createDataFrame(stations, STATION), now(), table)
    got = {}
    for r in options.orderBy("trip_id", "option_rank").collect():
        got.setdefault(r["trip_id"], []).append((r["rent_uid"], r["return_uid"], round(r["score"], 6)))
    assert got == {t[0]: ranked(t, stations, looked_up) for t in trips if ranked(t, stations, looked_up)}
    open_legs = rec.missing_legs(options).collect()
    asked = {}
    for r in open_legs:
        asked.setdefault(r["trip_id"], []).append(r)
    for mine in asked.values():
        assert sorted(r["request"] for r in mine) == list(range(1, len(mine) + 1))
        assert len({(r["profile"], r["from_key"], r["to_key"]) for r in mine}) == len(mine)
        first = min(mine, key=lambda r: r["request"])
        assert all((first["option_rank"], first["priority"]) <= (r["option_rank"], r["priority"]) for r in mine)
    exact = {r["trip_id"] for r in rec.leg_status(options).where("routing = 'exact'").collect()}
    assert exact == set(got) - set(asked)
    assert rec.missing_legs(options, cap=2).count() == sum(min(2, len(m)) for m in asked.values())


def test_estimates_stay_in_range_and_move_one_way(spark):
    """Over a grid of stations, forecasts and times: within the docks, and from today's count towards the forecast."""
    r = random.Random(9)
    rows = [(b, d, a, f, float(m)) for b in (0, 4, 11) for d in (0, 3, 8) for a in (None, -5, 1, 45) for f in (None, -2.5, 3.5, 60.0) for m in (0, 7, 45, 300)]
    r.shuffle(rows)
    due = now() + F.make_interval(mins="a")
    value, moved = rec.estimate_bikes(F.col("b"), F.col("d"), due, F.col("f"), F.col("m"), now())
    by_case = {}
    for x in spark.createDataFrame(rows, "b long, d long, a int, f double, m double").select("*", value.alias("v"), moved.alias("x")).collect():
        assert 0 <= x["v"] <= x["b"] + x["d"]
        assert x["x"] == (x["a"] is not None and x["a"] > 0 and x["f"] is not None and x["m"] > 0)
        assert x["x"] or x["v"] == x["b"]
        by_case.setdefault((x["b"], x["d"], x["a"], x["f"]), []).append((x["m"], x["v"]))
    for case, line in by_case.items():
        values = [v for _, v in sorted(line)]
        assert values in (sorted(values), sorted(values, reverse=True)) and values[0] == case[0]


def test_trips_without_an_option_still_give_the_walk(spark):
    trips = spark.createDataFrame(journeys(4, 6), "trip_id long, origin_lat double, origin_lng double, dest_lat double, dest_lng double")
    closed = spark.createDataFrame([(*s[:6], False, *s[7:]) for s in town(4)], STATION)
    none = rec.recommend(trips, closed, now())
    walks = {r["trip_id"]: r for r in rec.walk_only(trips, none).collect()}
    assert none.count() == 0 and len(walks) == 6 and not any(w["walking_is_as_fast"] for w in walks.values())
    for t in journeys(4, 6):
        assert walks[t[0]]["walk_only_minutes"] == pytest.approx(metres(t[1:3], t[3:5]) * 1.3 / 75)


def brute(points, stations, k):
    return {p[0]: [s for _, s in sorted((round(metres(p[1:], s[1:]), 3), s[0]) for s in stations)[:k]] for p in points}


@pytest.mark.parametrize("side", [None, 50.0, 5000.0])
def test_knn_is_exact(spark, side):
    """A dense spot, a sparse rest, equal spots, far points, the date line and both poles."""
    rnd = random.Random(5)
    stations = [(f"c{i:03}", 24 + rnd.gauss(0, .002), 120 + rnd.gauss(0, .002)) for i in range(80)]
    stations += [(f"s{i:03}", 24 + rnd.uniform(-.3, .3), 120 + rnd.uniform(-.3, .3)) for i in range(40)]
    stations += [(f"t{i:03}", 24.1, 120.1) for i in range(15)] + [("east", 10.0, 179.9), ("west", 10.0, -179.9), ("pole", 89.9, 10.0)]
    points = [(i, 24 + rnd.uniform(-.4, .4), 120 + rnd.uniform(-.4, .4)) for i in range(60)]
    points += [(100, 10.0, 179.99), (101, 10.0, -179.99), (102, 89.9, -170.0), (103, -60.0, 0.0), (104, 24.1, 120.1), (105, 0.0, 0.0)]
    got = knn(spark.createDataFrame(points, "id int, lat double, lng double"),
              spark.createDataFrame(stations, "station_uid string, lat double, lng double"), 6, side=side)
    assert {r["id"]: [n["station_uid"] for n in r["neighbours"]] for r in got.collect()} == brute(points, stations, 6)


def test_knn_with_fewer_stations_than_k(spark):
    stations = spark.createDataFrame([("a", 1.0, 1.0), ("b", 50.0, 9.0)], "station_uid string, lat double, lng double")
    got = knn(spark.createDataFrame([(1, 1.0, 2.0)], "id int, lat double, lng double"), stations, 6).first()
    assert [n["station_uid"] for n in got["neighbours"]] == ["a", "b"]


def test_point_labels_levels_and_area(spark):
    stations = town(5, 12)
    points = [(i, *s[2:4]) for i, s in enumerate(stations)] + [(100 + i, s[2] + 0.001, s[3]) for i, s in enumerate(stations)] + [(999, -30.0, -70.0)]
    got = rec.describe_points(spark.createDataFrame(points, "id int, lat double, lng double"), spark.createDataFrame(stations, STATION)).collect()
    for r in got:
        far, uid = min((round(metres((r["lat"], r["lng"]), s[2:4]), 3), s[0]) for s in stations)
        name = next(s[1] for s in stations if s[0] == uid)
        assert (r["station_uid"], r["label"], r["out_of_area"]) == (uid, name if far < 60 else f"near {name}", far > 3000)
    area = rec.service_area(spark.createDataFrame(stations, STATION)).first()
    lats, lngs = [s[2] for s in stations], [s[3] for s in stations]
    assert area["south"] == pytest.approx(min(lats) - .08 * (max(lats) - min(lats))) and area["east"] == pytest.approx(max(lngs) + .08 * (max(lngs) - min(lngs)))
    levels = spark.createDataFrame([(o, n) for o in (True, False) for n in range(6)], "o boolean, n int")
    shown = levels.select("o", "n", availability_level(F.col("o"), F.col("n")).alias("x")).collect()
    assert all(r["x"] == ("closed" if not r["o"] else "none" if r["n"] == 0 else "low" if r["n"] < 3 else "ok") for r in shown)


@pytest.mark.parametrize("many", [0, 256])
def test_far_points_meet_few_of_many_stations(spark, monkeypatch, many):
    """Points far from a dense town descend to its near edge: no point meets all stations, and the nearest are exact."""
    from kerbflow.operators import knn as module
    r, sizes, whole = random.Random(8), {}, module.store

    def spied(df, name, **options):
        out = whole(df, name, **options)
        sizes.setdefault(name, []).append(out)
        return out
    monkeypatch.setattr(module, "store", spied)
    monkeypatch.setattr(module, "MANY", many)
    stations = [(f"s{i:04}", 50 + r.gauss(0, .03), 8 + r.gauss(0, .05)) for i in range(5000)]
    points = [(i, r.uniform(-60, 45), r.uniform(-170, 170)) for i in range(50)] + [(50, 50.0, 8.0), (51, None, 8.0), (52, -50.0, -172.0)]
    near = knn(spark.createDataFrame(points, "n long, lat double, lng double"), spark.createDataFrame(stations, "station_uid string, lat double, lng double"), 6)
    got = {row["n"]: [(round(s["meters"], 3), s["station_uid"]) for s in row["neighbours"] or []] for row in near.collect()}
    for n, lat, lng in points:
        if lat is None:
            assert got[n] == []
            continue
        want = sorted((round(metres((lat, lng), s[1:]), 3), s[0]) for s in stations)[:6]
        assert [s for _, s in got[n]] == [s for _, s in want] or all(abs(a[0] - b[0]) < 0.002 for a, b in zip(got[n], want))
    assert sum(row["n"] for row in sizes["candidates"][0].select(F.size("__near").alias("n")).collect()) < 5000
    assert sizes["descent"] and all(front.count() < 5000 for front in sizes["descent"])


def test_searches_with_a_stored_index_find_the_same(spark):
    from kerbflow.operators.search import match_stations, name_index
    r = random.Random(2)
    names = spark.createDataFrame([(str(i), "".join(r.choice("abAB ") for _ in range(r.randint(1, 7)))) for i in range(300)], "station_uid string, station_name string")
    asked = spark.createDataFrame([(i, "".join(r.choice("abB ") for _ in range(r.randint(0, 4)))) for i in range(60)], "q long, query string")
    index = name_index(names)
    assert sorted(match_stations(asked, names, index=index).collect()) == sorted(match_stations(asked, names).collect())


def test_trips_between_the_same_points_are_ranked_once(spark, monkeypatch):
    """Pairs are formed for each two end points, not for each trip; every trip gets them, a repeated trip as one."""
    seen, whole = [], rec.trip_candidates

    def counted(trips, *rest):
        seen.append(trips.count())
        return whole(trips, *rest)
    monkeypatch.setattr(rec, "trip_candidates", counted)
    first, second = journeys(8, 2)
    rows = [(i, *first[1:]) for i in range(20)] + [(100, *second[1:]), (100, *second[1:]), (200, None, *first[2:]), (100, *first[1:])]
    trips = spark.createDataFrame(rows, "trip_id long, origin_lat double, origin_lng double, dest_lat double, dest_lng double")
    stations = spark.createDataFrame([s[:4] + (9, 9) + s[6:] for s in town(8)], STATION)
    pairs = rec.trip_pairs(trips, stations, now()).groupBy("trip_id").count().collect()
    assert seen == [2] and len({r["count"] for r in pairs if r["trip_id"] < 100}) == 1
    options = [r.asDict() for r in rec.recommend(trips, stations, now()).collect()]
    by_trip = {i: sorted((r["option_rank"], round(r["score"], 6), r["rent_uid"], r["return_uid"]) for r in options if r["trip_id"] == i) for i in (0, 19, 100, 200)}
    assert len(by_trip[0]) == 3 and by_trip[0] == by_trip[19] and by_trip[200] == []
    assert [x[0] for x in by_trip[100]] == [1, 2, 3]
