"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import staged


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour (``b``) of each node ``a``, written so that the join can split hot nodes."""
    return staged(edges.groupBy("a").agg(F.min("b").alias("low")), "lowest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both).withColumn("low", F.least("low", "a"))
    moved = both.where("b > a").join(low, "a").where("b != low")
    return staged(moved.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them. Edges lead down."""
    low = _lowest(edges)
    moved = edges.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = low.select("a", F.col("low").alias("b"))
    return staged(moved.unionByName(own).distinct(), "small-star")


def connected_components(edges: DataFrame) -> DataFrame:
    """Each node of ``edges`` (``a``, ``b``) as ``node`` with the smallest node it reaches as ``root``.

    Alternates large and small stars until nothing moves; the number of rounds
    grows with the logarithm of the longest path. Every round is a written
    table, so no plan grows and a lost executor costs no earlier round.
    """
    edges = staged(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        edges = _small_star(_large_star(edges))
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(edges.select("b").distinct().selectExpr("b as node", "b as root"))
