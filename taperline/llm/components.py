"""Connected components of large graphs, by shrinking edges towards their smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import discard, sized, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); the component is its smallest node.

    Each round links the larger neighbours of every node to the smallest node around it, then the
    smaller ones likewise (large star, small star), until only stars are left: a number of rounds
    that grows with the logarithm of the graph. Nulls and loops are ignored; an empty table gives
    an empty result. Minima are combined before the shuffle, and joins on a node with many edges
    are split by the adaptive planner.
    """
    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    state, before = edge_state(current), None
    while state["n"] and state != before:
        n = 2 * state["n"]
        # Large star: a node's larger neighbours move to the smallest node it knows.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = sized(both.groupBy("a").agg(F.min("b").alias("m")), n).select("a", F.least("a", "m").alias("m"))
        large = sized(both.filter("b > a").join(smallest, "a"), n).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = sized(large.groupBy("a").agg(F.min("b").alias("m")), n)
        small = sized(large.join(least, "a"), n)
        linked = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        following = stored(sized(linked.filter("a <> b").distinct(), n), "edges")
        discard(current)
        current, before, state = following, state, edge_state(following)
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def edge_state(edges: DataFrame) -> dict:
    """Number and checksum of a set of edges."""
    mark = F.bit_xor(F.xxhash64("a", "b"))
    return edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(mark, F.lit(0)).alias("mark")).first().asDict()
