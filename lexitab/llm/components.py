"""Connected components of a table of links, and forests of links inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lexitab.session import materialise


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest position each of ``size`` nodes is linked to by the links ``(a[i], b[i])``.

    Roots hook under smaller roots and paths are halved until nothing changes: a few passes over
    the links, with no loop over single ones.
    """
    root = np.arange(size)
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (root[root] != root).any():
            root = root[root]


def _star(sides: DataFrame) -> DataFrame:
    """Every ``(u, v)`` with the least of ``u`` and all its ``v`` as ``m``.

    The minimum is combined before its exchange and unique per node, so a node with very many
    links is a skewed side that Spark can split.
    """
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    return sides.join(least, "u").withColumn("m", F.least("u", "m"))


def _stats(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; ``root`` is the smallest node that can
    be reached, the node itself for the smallest.

    Large-star and small-star steps in turn: the first hangs a node's larger neighbours under its
    smallest one, the second its smaller neighbours.  Both shrink every component towards a star, in
    few rounds also for long chains.  Each round is a written table; only two numbers reach the driver.
    Self-links, repeated links and links in both directions are fine; no links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, label)
    last = _stats(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        hung = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(hung.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), label)
        now = _stats(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
