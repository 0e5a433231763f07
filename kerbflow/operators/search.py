"""Station search by part of a name, and cleaning of place labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.convert import to_double
from kerbflow.operators.dedupe import top_per_key
from kerbflow.session import store

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of one length; empty for shorter text."""
    n = F.char_length(text)
    starts = F.when(n >= size, F.sequence(F.lit(1), n - F.lit(size - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def _postings(stations: DataFrame, limit: int) -> DataFrame:
    distinct = top_per_key(stations.select("station_uid", "station_name"), ["station_name"], [F.col("station_uid").asc()], limit)
    names = distinct.select("station_uid", "station_name", F.lower("station_name").alias("__name"), F.char_length("station_name").alias("__length"))
    return names.select("*", F.explode(F.concat(*[_grams(F.col("__name"), g) for g in range(1, GRAM + 1)])).alias("__gram"))


def name_index(stations: DataFrame, limit: int = 5) -> DataFrame:
    """Stored posting lists: one row for each name and each piece of one to three letters in it, in order of the pieces.

    Written once for a table of stations, and read by any number of searches. Equal names match alike and rank by id, so
    only the first `limit` stations of a name are kept; a search may ask for as many results at most. A piece that very
    many names have is spread over files like any other rows.
    """
    return store(_postings(stations, limit).repartitionByRange("__gram", "__name").sortWithinPartitions("__gram"), "name-index")


def match_stations(queries: DataFrame, stations: DataFrame, limit: int = 5, index: DataFrame | None = None) -> DataFrame:
    """Stations whose name contains the query text: earlier position first, then shorter name, then id.

    Each distinct text is searched once, however many rows ask for it. A text meets only the names that share its
    rarest piece of three letters, through an equi join; names that lack that piece cannot contain the text. With `index`
    the pieces of the names come from `name_index`; without it they are taken from the stations, those of the texts alone.
    """
    asked = queries.withColumn("__text", F.lower(F.trim("query"))).where(F.col("__text") != "")
    size = F.least(F.char_length("__text"), F.lit(GRAM))
    own = store(asked.select("__text").distinct().select("__text", F.explode(
        F.when(size == 1, _grams(F.col("__text"), 1)).when(size == 2, _grams(F.col("__text"), 2)).otherwise(_grams(F.col("__text"), GRAM))).alias("__gram")),
        "searched-pieces")
    wanted = own.select("__gram").distinct()
    if index is None:
        index = _postings(stations, limit)
    postings = store(index.join(wanted, "__gram", "left_semi"), "postings")
    frequency = postings.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    # A piece that no name has ends the search for its text: it counts zero and finds nothing.
    weighed = own.join(frequency, "__gram", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    rarest = top_per_key(weighed, ["__text"], [F.col("__n").asc(), F.col("__gram").asc()])
    hits = rarest.join(postings, "__gram").withColumn("position", F.expr("instr(__name, __text)")).where("position > 0")
    best = top_per_key(
        hits, ["__text"], [F.col("position").asc(), F.col("__length").asc(), F.col("station_uid").asc()], limit,
        rank="match_rank")
    return asked.join(best.select("__text", "match_rank", "station_uid", "station_name", "position"), "__text") \
        .drop("__text")


def clean_places(places: DataFrame, country: str, unnamed: str, separator: str = "・", parts: int = 3) -> DataFrame:
    """Geocoder results as a short name and a detail line without postcode, country and the name itself.

    Coordinates that came as text become numbers.
    """
    pieces = F.filter(F.transform(F.split(F.coalesce("display_name", F.lit("")), ","), lambda p: F.trim(p)),
                      lambda p: p != "")
    name = F.coalesce(F.when(F.col("name") != "", F.col("name")), F.try_element_at(pieces, F.lit(1)), F.lit(unnamed))
    # `name` is computed first so that the filter compares with one column.
    named = places.withColumn("__pieces", pieces).withColumn("name", name)
    detail = F.filter(F.col("__pieces"), lambda p: (p != F.col("name")) & ~p.rlike("^[0-9]+$") & (p != F.lit(country)))
    placed = named.withColumns({c: to_double(F.col(c)) for c in ("lat", "lon", "lng") if c in places.columns})
    return placed.withColumn("detail", F.array_join(F.slice(detail, 1, parts), separator)).drop("__pieces")
