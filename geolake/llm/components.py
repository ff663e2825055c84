"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its least neighbour (or itself) to its larger neighbours, or to itself and the smaller ones.

    The minima are written before they are joined, so a node with very many neighbours is a skewed join,
    which Spark splits, and its minimum is combined before any shuffle.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
    least = least.withColumn("least", F.least("node", "least"))
    joined = both.join(least, F.col("a") == F.col("node"))
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return stored(out.filter("a <> b").distinct(), "edges")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) -> node, root: for each node with a link the smallest node it can reach. Every round is written out.

    Needs about as many rounds as the logarithm of the longest chain; fails rather than stop early.
    """
    links = links.filter("a is not null and b is not null")
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")

    def state(e: DataFrame) -> tuple:
        # Stars: nothing is both a member and a centre, and every member has one centre.
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        edges = _star(_star(edges, True), False)
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(centres)
