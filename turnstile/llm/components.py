"""Connected components of an undirected graph given as an edge table.

Alternating large-star / small-star contraction (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each round hangs a vertex's larger
neighbours on the smallest vertex it sees, until every component is a star.
The edge table never grows, the round number is logarithmic in practice, and
each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import discard, lookup, written


def _star(edges: DataFrame, most: int) -> DataFrame:
    """(u, v, m): every edge of ``edges`` with the least vertex among u and its
    neighbours v.  A vertex with a large share of all edges, at most ``most``,
    is looked up by broadcast, so its edges stay spread out."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return lookup(edges, least, "u", "n", how="inner", total=most).select(
        "u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame, most: int) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    return (_star(both, 2 * most).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame, most: int) -> DataFrame:
    # Every edge points from the larger to the smaller vertex.
    least = _star(edges, most)
    out = least.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no one's smaller end."""
    twice = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    both = edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return both.isEmpty() and twice.isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every vertex that has an edge; ``component`` is the
    smallest vertex reachable.  Self-loops, repeated edges and edges with a null
    end are allowed; the latter two add nothing.  An empty edge table gives an
    empty result."""
    a, b = F.col(u), F.col(v)
    edges = (edges.where(a.isNotNull() & b.isNotNull())
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col("u") != F.col("v")).distinct())
    edges = written(edges, "edges")
    while not _is_stars(edges):
        n = edges.count()  # neither step makes more edges than it takes
        large = written(_large_star(edges, n), "edges")
        discard(edges)
        edges = written(_small_star(large, n), "edges")
        discard(large)
    # Every component is now a star around its smallest vertex.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
