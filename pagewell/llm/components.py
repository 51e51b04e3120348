"""Connected components of links between documents, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """`node, component` for every node of the links `a, b`; the component is its smallest node.

    Each round joins every node to the smallest node near it, first through larger and
    then through smaller neighbours; the rounds needed grow with the logarithm of the
    longest chain. A round is written to the shared folder. A node with very many links
    is only ever grouped by a minimum and joined, never collected. Links may repeat, run
    both ways or lead to the node itself; no links give an empty table.
    """
    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = materialise(ordered(links), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(near, both["a"] == near["n"]).where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(ordered(large), "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, large["a"] == least["n"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(ordered(
            small.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
