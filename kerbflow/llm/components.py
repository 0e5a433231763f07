"""Connected components of a graph too large for one machine, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.session import store

MAX_ROUNDS = 60


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Least of each node's neighbours and itself; partial sums come before the shuffle, so a hub is no hot key."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge (a, b) of two long columns; root is the smallest node of its component.

    Alternates the large-star and small-star steps (Kiveris and others, 2014) until nothing changes: each node's larger
    neighbours, then its smaller ones, are hung below the smallest node it knows. Rounds grow with the logarithm of the
    longest chain. Every round is written to the shared folder, so a lost executor costs one round at most. Self-links,
    repeated and reversed edges are allowed; null ends are no edge.
    """
    edges = store(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                  "components")
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least_neighbour(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        edges = store(small, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
