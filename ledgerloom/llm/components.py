"""Connected components of a graph of links, in Spark.

Alternates two steps until nothing changes: every node hands its larger
neighbours the smallest node it knows of, then its smaller neighbours. Each
node ends linked to its component's smallest node alone. The smallest
neighbour is a grouped minimum (summed up before the shuffle), written and
joined back to the links: both sides of that join are plain shuffles, which
adaptive execution splits when one node has very many links. No task gathers
a node's neighbours.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = materialize(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    joined = links.join(least, "a")
    handed = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches.

    ``links``: columns a, b (bigint, any direction; repeated and self links
    are allowed, null ones are ignored). Returns node, root for every node of
    a link to another node, roots included; no rows for no links.
    """
    now = materialize(links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        now = materialize(_small_star(_large_star(now)), "links")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            break
        mark = seen
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


class Forest:
    """Components of a task's own nodes 0 .. n-1, by whole arrays of links.

    A task that finds many links among few nodes returns one link for each
    node it has linked, never all pairs.
    """

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each linked node and its root."""
        nodes = np.flatnonzero(self.root != np.arange(len(self.root)))
        return nodes, self.root[nodes]
