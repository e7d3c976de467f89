"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsignal.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    flipped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select("src", "dst").unionByName(flipped)


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node under the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    return (
        around.filter("dst > src")
        .join(least, "src")
        .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        .filter("src <> dst")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours under the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("low"))
    siblings = down.join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    own = least.select("src", F.col("low").alias("dst"))
    return siblings.filter("src <> dst").unionByName(own)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node on an edge; the root is the smallest node.

    ``edges`` is ``(src, dst)`` in any direction and order. Hubs are reduced to one
    minimum per node map-side; the joins with it leave hot nodes to adaptive skew
    handling. Every round is written to the shared folder, and the rounds, about
    the logarithm of the longest chain, end when the edges stay the same.
    """
    current = materialise(edges.select("src", "dst").filter("src <> dst").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        step = _small_star(_large_star(current).distinct()).distinct()
        current = materialise(step, "edges")
        state = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h"),
        ).first()
        if seen == (state["n"], state["h"]):
            break
        seen = (state["n"], state["h"])
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("dst").alias("node")).distinct()
    return current.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
