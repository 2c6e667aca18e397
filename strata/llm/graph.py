"""Connected components of a large edge list, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> one row (node, label) per node that has an edge, label being the
    smallest node of its component. An edge from a node to itself, or with a null end, is no edge.

    Alternating star contraction: in each round every node hangs its larger neighbours, then its
    smaller ones, onto the smallest node it knows, until the edges are stars around the component
    minima. Each half round is one aggregation (minimum per node) and one join of the edges with it;
    neighbour lists are never gathered, so a hub is only a skewed join key, which AQE splits. Rounds
    grow with the logarithm of the longest chain. Edges are written after each round.
    """
    e = stage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        e = stage(_small_star(_large_star(e)), "stars")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle; raise MAX_ROUNDS")
    nodes = e.select(F.col("b").alias("node"), F.col("a").alias("label"))
    roots = e.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return nodes.unionByName(roots)


def _large_star(e: DataFrame) -> DataFrame:
    """Each node u links its neighbours above u to the smallest of u and its neighbours."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return linked.filter("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node u links its neighbours below u, and itself, to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()
