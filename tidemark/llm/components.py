"""Connected components of an edge table by alternating large and small stars.

Every round points each node at the smallest neighbour it knows: the large star hangs a node's
larger neighbours below that smallest one, the small star does the same with the smaller ones. The
number of rounds grows with the logarithm of the longest chain. A node with very many neighbours is
never gathered in one place: its smallest neighbour is a plain minimum (combined before the
shuffle) that is joined back, so AQE can split its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"),
                                                        F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the long pairs ``a, b``; the root is its smallest node.

    Pairs with a null and loops are ignored. A node without any edge does not occur.
    """
    edges = settle(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                      F.least("a", "b").alias("v")).distinct(), "edges")
    before = _signature(edges)
    while True:
        edges = settle(_small_star(_large_star(edges)), "stars")
        now = _signature(edges)
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
