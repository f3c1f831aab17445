"""Connected components of a graph held as a DataFrame of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another; ``component`` is the smallest node reachable.

    Each round hangs all neighbours of a node under the smallest one: a partial minimum before the shuffle, then an
    equi-join that adaptive execution may split when one node has very many neighbours. Rounds are written to the shared
    folder, so their number (logarithmic in the diameter) does not lengthen the lineage. Null ends and self-loops are
    ignored; repeated edges count once; no edges give no rows.
    """
    now = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
        "edges",
    )
    seen = None
    while (state := _fingerprint(now)) != seen:
        seen = state
        before, now = now, materialize(_small_star(_large_star(now)), "edges")
        discard(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves under the node's smallest neighbour (or the node)."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move under the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
