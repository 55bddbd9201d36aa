"""Connected components of an edge table, by alternating star operations.

Each round first links every larger neighbour of a node to the smallest node of
its neighbourhood, then does the same among the smaller neighbours.  Both are a
minimum per node (partially aggregated) and a join, so a hub with a million
edges is pre-aggregated and its join can be split by AQE.  The rounds needed
grow with the logarithm of a component's size.  Edges are checkpointed each
round; only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextbest.llm.common import checkpointed


class UnionFind:
    """Disjoint sets over 0..n-1, for the bounded groups inside one task."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def union(self, a: int, b: int) -> bool:
        """True when a and b were in different sets."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
        edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(low, "u").select(
        F.col("v").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from its larger to its smaller end
    low = edges.groupBy("src").agg(F.min("dst").alias("m"))
    moved = edges.join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.where("src <> dst").unionByName(
        low.select("src", F.col("m").alias("dst"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(src, dst) -> (node, root): the smallest node of each linked node's component."""
    now = checkpointed(edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    last = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or tuple(state) == last:
            break
        last = tuple(state)
        now = checkpointed(_small_star(_large_star(now)))
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds")
    stars = now.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return stars.unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("root"))
                             .distinct())
