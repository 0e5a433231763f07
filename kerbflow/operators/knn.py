"""Exact k nearest stations for any number of points, without a cross join.

Stations and points are placed in nested cubes of the globe. A cube whose 3x3x3 neighbourhood holds k stations
bounds the distance of the k-th nearest one, so the stations of a slightly wider neighbourhood are a complete
candidate set for every point of the cube. Where that neighbourhood holds many stations (points far from all of them see
them all in one cube), the cubes are descended instead: level by level, only those stay whose nearest corner is not
beyond the k-th farthest one. The candidates are then pruned per cube with the triangle inequality, again without losing
any possible neighbour. Only then do points meet candidates, through an equi join on their cube, and each row ranks its
own short list: points are never shuffled by trip and never grouped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions.geo import EARTH_RADIUS_M, cartesian, distance_mm
from kerbflow.operators.dedupe import top_per_key
from kerbflow.session import store

CUBE = ["__x", "__y", "__z"]
SPOT = ["px", "py", "pz"]
HERE = ["__hx", "__hy", "__hz"]
NEAR = (-1, 0, 1)
FINE = ["__fx", "__fy", "__fz"]
MIDDLE = ["__mx", "__my", "__mz"]
LOW, HIGH = ["__lx", "__ly", "__lz"], ["__ux", "__uy", "__uz"]
# With more stations in its neighbourhood a cube descends, so many levels at a time.
MANY = 256
STEP = 3


def _levels(side: float) -> int:
    """Doublings after which one cube spans half the globe, so that its neighbourhood holds everything."""
    level = 0
    while side * 2**level < 2 * EARTH_RADIUS_M:
        level += 1
    return level


def _cube(position: tuple[Column, Column, Column], side: Column | float) -> list[Column]:
    size = side if isinstance(side, Column) else F.lit(float(side))
    return [F.floor(p / size).alias(n) for p, n in zip(position, CUBE)]


def _at_level(fine: list[str], level: Column) -> list[Column]:
    """Cube at a coarser level from the finest one. A right shift floors, also below zero."""
    return [F.call_function("shiftright", F.col(c), level).alias(c) for c in fine]


def _neighbourhood() -> Column:
    """The 27 cubes around a cube, as offsets to explode."""
    return F.array(*[F.struct(*[F.lit(v).alias(f"d{c}") for v, c in zip((i, j, k), "xyz")])
                     for i in NEAR for j in NEAR for k in NEAR])


def _shifted(sign: int = 1) -> list[Column]:
    return [(F.col(c) + sign * F.col(f"__d.d{a}")).alias(c) for c, a in zip(CUBE, "xyz")]


def _station_index(stations: DataFrame, k: int) -> DataFrame:
    """Stations that can be among the k nearest of some point: of those at one spot only the first k by id."""
    usable = stations.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("station_uid", "lat", "lng")
    spots = top_per_key(usable, ["lat", "lng"], [F.col("station_uid").asc()], k)
    x, y, z = cartesian(F.col("lat"), F.col("lng"))
    return spots.select("*", x.alias("px"), y.alias("py"), z.alias("pz"))


def fitting_side(index: DataFrame, mean: float = 1.25, most: int = 64, finest: float = 1.0) -> float:
    """Edge of the largest cubes that mostly hold one station spot, and nowhere many, so candidate lists stay short.

    One small aggregate over the stations; a single number reaches the driver.
    """
    top = _levels(finest)
    fine = index.select(*SPOT).distinct().select(*_cube(tuple(F.col(c) for c in SPOT), finest))
    leveled = fine.select(*CUBE, F.explode(F.sequence(F.lit(0), F.lit(top))).alias("__level")).select(
        "__level", *_at_level(CUBE, F.col("__level")))
    held = leveled.groupBy("__level", *CUBE).agg(F.count(F.lit(1)).alias("n")).groupBy("__level").agg(
        F.avg("n").alias("mean"), F.max("n").alias("most"))
    level = held.where((F.col("mean") <= mean) & (F.col("most") <= most)).agg(F.max("__level")).first()[0]
    return finest * 2 ** (level or 0)


def point_boxes(points: DataFrame, spots: list[tuple[str, str]], side: float) -> DataFrame:
    """Cubes that hold points, and the box around the points in each."""
    at = [points.select(*_cube(cartesian(F.col(lat), F.col(lng)), side), *[c.alias(n) for c, n in zip(cartesian(F.col(lat), F.col(lng)), SPOT)])
          for lat, lng in spots]
    ends = [f(p).alias(n) for f, names in ((F.min, LOW), (F.max, HIGH)) for p, n in zip(SPOT, names)]
    return reduce(DataFrame.union, at).where(F.col("__x").isNotNull()).groupBy(*CUBE).agg(*ends)


def _length(parts: list[Column]) -> Column:
    return F.sqrt(sum((p * p for p in parts), F.lit(0.0)))


def _descended(cubes: DataFrame, nodes: DataFrame, k: int, top: int) -> DataFrame:
    """Finest cubes of stations that each of these cubes has to look at.

    `cubes` start with the cubes around them at a coarse level. `nodes` has the number of stations and the box around them
    for every STEP-th level. Of the cubes that are left, the k-th farthest corner bounds the way to the k-th station; what
    lies wholly beyond it goes, and the others are replaced by the smaller cubes in them.
    """
    box = ["__n", *LOW, *HIGH]
    own = [*FINE, *MIDDLE, "__margin"]

    def pruned(front: DataFrame) -> DataFrame:
        least = _length([F.greatest(F.col(lo) - F.col(m), F.col(m) - F.col(hi), F.lit(0.0)) for lo, hi, m in zip(LOW, HIGH, MIDDLE)])
        most = _length([F.greatest(F.abs(F.col(lo) - F.col(m)), F.abs(F.col(hi) - F.col(m))) for lo, hi, m in zip(LOW, HIGH, MIDDLE)])
        ranked = front.withColumns({"__least": least, "__most": most})
        held = F.sum("__n").over(Window.partitionBy(*FINE).orderBy("__most").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        reach = F.min(F.when(F.col("__held") >= k, F.col("__most"))).over(Window.partitionBy(*FINE))
        return ranked.withColumn("__held", held).withColumn("__reach", reach).where(
            F.col("__reach").isNull() | (F.col("__least") <= F.col("__reach") + F.col("__margin"))).select(*own, "__level", *CUBE, *box)

    front = cubes.withColumn("__d", F.explode(_neighbourhood())).select(*own, "__level", *_shifted()).join(nodes, ["__level", *CUBE])
    for level in range(top, 0, -STEP):
        left = store(pruned(front), "descent")
        inside = [f"{c}_in" for c in CUBE]
        smaller = nodes.where(F.col("__level") == level - STEP).select(
            *[F.call_function("shiftright", F.col(c), F.lit(STEP)).alias(i) for c, i in zip(CUBE, inside)], "__level", *CUBE, *box)
        down = left.where(F.col("__level") == level).select(*own, *[F.col(c).alias(i) for c, i in zip(CUBE, inside)])
        front = left.where(F.col("__level") < level).unionByName(down.join(smaller, inside).select(*own, "__level", *CUBE, *box))
    return pruned(front).select(*own, *CUBE)


def candidates_per_cube(boxes: DataFrame, index: DataFrame, k: int, side: float) -> DataFrame:
    """For each finest cube of `point_boxes`: all stations that may be among the k nearest of a point in its box."""
    top = _levels(side)
    coarsest = -(-top // STEP) * STEP
    levels = F.explode(F.sequence(F.lit(0), F.lit(coarsest))).alias("__level")
    level = F.col("__level")

    placed = index.select("*", *_cube((F.col("px"), F.col("py"), F.col("pz")), side))
    # Stations and their box, by cube of every level. Sums are taken per cube of the finest level before they are spread.
    finest = placed.groupBy(*CUBE).agg(F.count(F.lit(1)).alias("__n"), *[f(p).alias(n) for f, names in ((F.min, LOW), (F.max, HIGH)) for p, n in zip(SPOT, names)])
    nodes = store(finest.select("__n", *LOW, *HIGH, *CUBE, levels).select("__n", *LOW, *HIGH, "__level", *_at_level(CUBE, level))
                  .groupBy("__level", *CUBE).agg(F.sum("__n").alias("__n"), *[F.min(c).alias(c) for c in LOW], *[F.max(c).alias(c) for c in HIGH]),
                  "station-cubes")

    # Cubes whose neighbourhood holds at least k stations.
    around = (nodes.withColumn("__d", F.explode(_neighbourhood())).select("__level", "__n", *_shifted())
              .groupBy("__level", *CUBE).agg(F.sum("__n").alias("__around")))
    half = [((F.col(lo) + F.col(hi)) / 2).alias(m) for lo, hi, m in zip(LOW, HIGH, MIDDLE)]
    margin = _length([F.col(hi) - F.col(lo) for lo, hi in zip(LOW, HIGH)]) + F.lit(0.05)
    own = boxes.select(*[F.col(c).alias(f) for f, c in zip(FINE, CUBE)], *half, margin.alias("__margin"))
    mine = [*FINE, *MIDDLE, "__margin"]
    coarser = [F.call_function("shiftright", F.col(f), level).alias(c) for f, c in zip(FINE, CUBE)]
    located = own.select("*", levels).select(*mine, "__level", *coarser).join(around, ["__level", *CUBE], "left")
    # All k neighbours lie within twice the diagonal of the smallest such cube, which is less than four of its sides:
    # the neighbourhood two levels up holds them. Without any cube of k stations the top level takes all.
    search = (located.groupBy(*mine).agg(
        F.min(F.when(F.col("__around") >= k, level)).alias("__smallest"), F.map_from_entries(F.collect_list(F.struct(level, "__around"))).alias("__counts"))
        .withColumn("__level", F.least(F.coalesce(F.col("__smallest") + 2, F.lit(coarsest)), F.lit(coarsest)))
        .withColumn("__meets", F.try_element_at("__counts", level)).drop("__counts", "__smallest"))
    search = store(search, "searched-cubes")
    far = F.col("__meets") > MANY
    probes = search.where(~far | F.col("__meets").isNull()).select(*mine, "__level", *coarser).withColumn("__d", F.explode(_neighbourhood())).select(
        *mine, "__level", *_shifted())
    leveled = placed.select(*index.columns, *CUBE, levels).select(*index.columns, "__level", *_at_level(CUBE, level))
    pairs = probes.join(leveled, ["__level", *CUBE]).select(*mine, *index.columns)
    many = search.where(far).withColumn("__level", F.ceil(level / STEP).cast("int") * STEP)
    if not many.isEmpty():
        nodes = nodes.where(level % STEP == 0)
        seen = _descended(many.select(*mine, "__level", *coarser), nodes, k, coarsest)
        pairs = pairs.unionByName(seen.join(placed, CUBE).select(*mine, *index.columns))
    gap = _length([F.col(m) - F.col(p) for m, p in zip(MIDDLE, SPOT)])
    # A station further from the middle than the k-th one by more than the box's diagonal is never needed.
    whole = Window.partitionBy(*FINE).orderBy("__gap").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reach = F.nth_value("__gap", k).over(whole)
    ranged = pairs.select(*FINE, *index.columns, "__margin", gap.alias("__gap")).withColumn("__reach", reach)
    return (
        ranged.where(F.col("__reach").isNull() | (F.col("__gap") <= F.col("__reach") + F.col("__margin")))
        .groupBy(*[F.col(f).alias(c) for f, c in zip(FINE, CUBE)])
        .agg(F.collect_list(F.struct("station_uid", "lat", "lng", "px", "py", "pz")).alias("__near"))
    )


def _nearest(lat: str, lng: str, k: int) -> Column:
    """The first k of a row's candidates by distance to the millimetre, then id.

    The cheap squared straight line finds the reach of the k-th candidate first; only candidates that can still tie
    with it get their distance on the globe. The one-element array holds the reach, computed once per row.
    """
    def line(s: Column) -> Column:
        x, y, z = [s[c] - F.col(p) for c, p in zip(SPOT, HERE)]
        return x * x + y * y + z * z

    lines = F.sort_array(F.transform(F.col("__near"), line))
    reach = F.sqrt(F.try_element_at(lines, F.lit(k))) + F.lit(0.01)
    limit = F.coalesce(reach * reach, F.lit(float("inf")))

    def ranked(bound: Column) -> Column:
        close = F.filter(F.col("__near"), lambda s: line(s) <= bound)
        return F.slice(F.sort_array(F.transform(close, lambda s: F.struct(
            distance_mm(F.col(lat), F.col(lng), s["lat"], s["lng"]).alias("meters"),
            s["station_uid"].alias("station_uid")))), 1, k)

    return F.element_at(F.transform(F.array(limit), ranked), 1)


def candidate_index(points: DataFrame, stations: DataFrame, k: int, spots: list[tuple[str, str]],
                    side: float | None = None) -> tuple[DataFrame, float]:
    """Stored candidates of every cube that holds a point, and the edge of the cubes.

    `spots` lists the coordinate columns of the points. The index serves these points: candidates follow the box around
    the points of a cube.
    """
    index = store(_station_index(stations, k), "stations")
    size = side or fitting_side(index)
    return store(candidates_per_cube(point_boxes(points, spots, size), index, k, size), "candidates"), size


def rank_candidates(points: DataFrame, near: DataFrame, size: float, k: int, spots: dict[str, tuple[str, str]]) -> DataFrame:
    """Points with one ranked array per spot. Each row ranks its own candidates; points are not shuffled for it."""
    out = points
    for name, (lat, lng) in spots.items():
        position = out.select("*", *[c.alias(n) for c, n in zip(cartesian(F.col(lat), F.col(lng)), HERE)])
        placed = position.select("*", *_cube(tuple(F.col(c) for c in HERE), size))
        out = placed.join(near, CUBE, "left").select(*out.columns, _nearest(lat, lng, k).alias(name))
    return out


def knn_columns(points: DataFrame, stations: DataFrame, k: int, spots: dict[str, tuple[str, str]],
                side: float | None = None) -> DataFrame:
    """Points with one array of the k nearest stations per spot: (meters, station_uid), nearest first, ties by id.

    `spots` names the arrays and their coordinate columns. The candidates of all spots are found once and stored, so
    Spark knows their size when it chooses the join. `side` is the edge of the finest cube in metres. It changes the
    work done, never the result; by default it follows the station density.
    """
    near, size = candidate_index(points, stations, k, list(spots.values()), side)
    return rank_candidates(points, near, size, k, spots)


def knn(points: DataFrame, stations: DataFrame, k: int = 6, lat: str = "lat", lng: str = "lng",
        out: str = "neighbours", side: float | None = None) -> DataFrame:
    """Points with the array of their k nearest stations; see `knn_columns`."""
    return knn_columns(points, stations, k, {out: (lat, lng)}, side)
