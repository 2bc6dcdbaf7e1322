"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (u, v longs): root is the least node that can be reached.

    Self-loops and repeated edges are ignored; no edges give no rows; null ends are dropped. Each round is written to the
    shared folder, so no round's lineage outlives it; rounds grow with the logarithm of the longest chain, not with the rows.
    """
    edges = edges.filter("u != v").select("u", "v").distinct()
    edges = materialize(edges, "edges")
    sign = _signature(edges)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        old, edges = edges, materialize(_small_star(_large_star(edges)), "edges")
        forget(old)
        was, sign = sign, _signature(edges)
        if was == sign:
            break
    else:
        raise RuntimeError("components have not settled; raise max_rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
