"""Connected components by repeated contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

_MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); nodes of one component share a root.

    Each round maps every node to its neighbour of smallest hash (under a seed of the round), or
    to itself where its own hash is smallest, and replaces edges by the edges between the
    images. The nodes left shrink by a constant share, so the rounds grow with the logarithm
    of the longest chain. Every round is a written table; no list of links or members is ever
    gathered. Null ends and loops take no part; repeated edges count once; no edges, no nodes.
    """
    edges = cut_lineage(edges.select("a", "b").filter("a <> b").distinct())
    labels = None
    for number in range(_MOST_ROUNDS):
        if edges.isEmpty():
            break
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(number), F.col(c)).alias("h"), F.col(c).alias("v"))
        nearest = ends.groupBy("a").agg(F.min(rank("b")).alias("m"))
        image = cut_lineage(
            nearest.select(F.col("a").alias("node"), F.least(F.col("m"), rank("a"))["v"].alias("image"))
        )
        if labels is None:
            labels = cut_lineage(image.select("node", F.col("image").alias("root")))
        else:
            moved = image.select(F.col("node").alias("root"), "image")
            labels = cut_lineage(
                labels.join(moved, "root", "left").select("node", F.coalesce("image", "root").alias("root"))
            )
        at = image.select(F.col("node").alias("a"), F.col("image").alias("x"))
        to = image.select(F.col("node").alias("b"), F.col("image").alias("y"))
        edges = cut_lineage(
            edges.join(at, "a").join(to, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    else:
        raise RuntimeError("components did not settle")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
