"""Connected components of a graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the smallest node it can reach.

    Each round points all neighbours of a node at the smallest one (Kiveris et al., "Connected Components
    in MapReduce and Beyond"), so the number of rounds grows with the logarithm of the longest path. A
    round's edges are written to shared storage. Rounds end when the edges are stars around smallest nodes; whether
    they are is all that reaches the driver.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = materialize(pairs, "edges")
    while not _stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(_lowest(both), "a").select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a").alias("a"), F.col("low").alias("b"))))
        small = large.join(_lowest(large), "a").select(ends.alias("edge")).select("edge.a", "edge.b")
        pairs = materialize(small.where("a <> b").distinct(), "edges")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _lowest(pairs: DataFrame) -> DataFrame:
    """``(a, low)``: the smallest ``b`` of each ``a``.

    Grouped by a second column that follows from the first, so that the join on ``a`` shuffles this side anew and
    adaptive execution can split the partition of a node with very many neighbours.
    """
    return pairs.groupBy("a", F.pmod(F.col("a"), F.lit(2)).alias("half")).agg(F.min("b").alias("low")).drop("half")


def _stars(pairs: DataFrame) -> bool:
    """Whether every ``a`` has one ``b``, which points at none itself."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("met")).unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("met")))
    counted = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("met").alias("met"))
    return counted.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("met") > 0))).isEmpty()
