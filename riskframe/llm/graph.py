"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the edges ``(a, b)``; the component is its smallest node.

    Alternates large and small stars until nothing changes. Every step is a minimum per node, combined
    before its shuffle, and a join back; no node's neighbours are ever gathered, links stay in tables. A hub
    is one row on its side of the join, so Spark can split the other side.
    """
    pair = F.col("a") != F.col("b")
    edges = materialize(
        edges.filter(pair).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    seen = _signature(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # large star: larger neighbours of u move to the least of u and its neighbours
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        # small star: smaller neighbours of u, and u, move to the least of them
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(small_least, "b")
        stars = small.select(F.col("m").alias("a"), F.col("a").alias("b")).union(small.select("m", "b"))
        edges = materialize(stars.filter(pair).distinct(), "links")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
