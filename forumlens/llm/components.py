"""Connected components of a graph given as an edge table.

Alternating star steps: each node hands its smallest neighbour to its larger ones, then to its smaller
ones, until nothing changes; the number of rounds grows with the logarithm of the longest chain. A hub
is one group for a minimum (combined before the shuffle) and one side of a join (split by the adaptive
skew join). Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.session import stored


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over (a, b) with a > b."""
    around = edges if not larger else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = around.join(least, "a")
    if larger:
        met = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        met = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return met.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b) but the roots; a root is the smallest node of its component."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        edges = stored(star(star(edges, True), False), "edges")
