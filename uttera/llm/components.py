"""Connected components of a link table by alternating star contraction, on Spark throughout."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the least of itself and its neighbours; summed up before the shuffle, so a hub is no hot key."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of these."""
    moved = edges.join(_least(edges), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(_least(edges).select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots themselves; a root is its component's least node.

    Each round is written to the shared folder, which cuts the plan; rounds are of the order of the logarithm of the
    longest path. A round that changes nothing ends it. Links of a node to itself and links with a null are not taken.
    """
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = materialize(pairs, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        edges = materialize(_small_star(_large_star(edges)), "links")
