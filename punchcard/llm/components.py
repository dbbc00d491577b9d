"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import written


def _settled(edges: DataFrame) -> bool:
    """True if the edges are stars: a node that points to a smaller one does so once, and
    no node points to it. As each step keeps the components, these are the result."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("low"))
    )
    roles = ends.groupBy("node").agg(F.sum("low").alias("lows"), F.count("*").alias("ends"))
    return roles.filter("lows > 1 OR (lows = 1 AND ends > 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them. Here v < u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of an edge (u, v), two columns of longs.

    The component is the least node that can be reached. Loops and repeated edges
    do no harm; an edge with a null is left out; no edges give no rows. Each step
    is written to the shared folder, and the number of steps is about the
    logarithm of the longest path. Minima are taken before the shuffle, and the
    joins are such that a node with very many edges can be split.
    """
    ordered = edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = written(ordered.distinct(), "edges")
    while not _settled(now):
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
