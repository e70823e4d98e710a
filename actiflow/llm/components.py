"""Connected components of a link table, with Spark joins only.

Alternates two rounds until the table is a set of stars: every node hangs its larger
neighbours, then its smaller ones, on the smallest node it knows. The number of rounds
grows with the logarithm of the longest chain. Each round is checkpointed to the shared
folder; per node only a minimum is aggregated (with map-side combine), so a node with a
third of all links is never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiflow.llm.common import stored


def _least(edges: DataFrame, by: str, other: str) -> DataFrame:
    return edges.groupBy(F.col(by).alias("node")).agg(F.min(other).alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b; any orderable type);
    root is the smallest node reachable. Nodes without links do not appear."""
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                   .filter("hi <> lo").distinct(), "links")
    while True:
        # Larger neighbours of a node go to the least of the node and its neighbours.
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = _least(both, "u", "v").select("node", F.least("node", "least").alias("least"))
        large = (edges.join(least, F.col("lo") == F.col("node"))
                 .select("hi", F.col("least").alias("lo")).distinct())
        # Smaller neighbours of a node, and itself, go to the least of them.
        least = _least(large, "hi", "lo")
        joined = large.join(least, F.col("hi") == F.col("node"))
        small = (joined.filter("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
                 .union(least.select(F.col("node").alias("hi"), F.col("least").alias("lo")))
                 .distinct())
        small = stored(small, "links")
        # Stars: no node is both a member and a root, and no member has two roots.
        roots = small.select(F.col("lo").alias("r")).distinct()
        unfinished = (small.join(roots, F.col("hi") == F.col("r"), "left_semi").limit(1).count()
                      + small.groupBy("hi").count().filter("count > 1").limit(1).count())
        edges = small
        if not unfinished:
            break
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            .union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct())


class Forest:
    """Union-find over 0..n-1 within one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
