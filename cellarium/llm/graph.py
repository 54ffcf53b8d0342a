"""Connected components: of a link table, by turns of large-star and small-star steps; of one task's arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.plans.scratch import settle


class Union:
    """Components of places 0 to n - 1, under links given as arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            np.minimum.at(self.root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each step points nodes at the smallest neighbour of one of theirs, so chains shrink by
    a factor and a few rounds suffice.  Every round is two aggregates and two joins over the links
    left, written once; the driver sees a count and a checksum.  Links of a node to itself are fine.
    """
    edges = settle(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        edges = settle(_small_star(settle(_large_star(edges), "star")), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one of it and the node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these; needs a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").where(F.col("b") != F.col("m"))
    others = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return others.unionByName(own).distinct()
