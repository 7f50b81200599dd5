"""Connected components by alternating large-star and small-star."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low"))
    return both.join(lowest, "u").filter(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.least("low", "u").alias("v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    stars = lowest.select("u", F.col("low").alias("v"))
    return moved.unionByName(stars).filter(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
    ).first()
    return row.n, row.x


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); component is the smallest node.

    Each round is written, so lost executors cost one round; the driver compares a
    count and a checksum.  Loops, repeated edges and both directions are allowed.
    """
    edges = edges.select("u", "v").filter("u != v").distinct()
    edges = materialize(edges, f"{label}-edges")
    state = _state(edges)
    if not state[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        edges = materialize(_small_star(_large_star(edges)), f"{label}-stars")
        now = _state(edges)
        if now == state:
            break
        state = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)
