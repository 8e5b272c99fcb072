"""Connected components of links between ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.sources.scratch import pin


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links from each row of a symmetric matrix to the first row of its component, rows alone left out."""
    n, out = len(linked), []
    free = linked.any(axis=1)
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        frontier = np.array([root])
        while len(frontier):
            reached = np.flatnonzero(linked[frontier].any(axis=0) & free)
            free[reached] = False
            out += [(root, int(r)) for r in reached]
            frontier = reached
    return out


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, from links ``a``, ``b`` (long, not null).

    Nodes without a link to another are not listed. Large and small stars in turn
    (Kiveris and others, 2014): every node hangs its larger neighbours, then its
    smaller ones and itself, below the smallest it knows, until all links lead
    to the smallest of their component. Rounds grow with the logarithm of the number of nodes;
    links are written after each, so no lineage builds up. A node with very many
    links is met by joins, which split hot keys, and sums, which combine early; its
    neighbours are never listed in one place.
    """
    oriented = links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x <> y").distinct()
    links = pin(oriented)
    size = _size(links)
    while size[0]:
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
        large = pin(both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct())
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").select(F.greatest("y", "m").alias("a"), F.least("y", "m").alias("m"))
        links = pin(
            small.where("a <> m").select(F.col("a").alias("x"), F.col("m").alias("y")).unionByName(least.select("x", F.col("m").alias("y"))).distinct()
        )
        now = _size(links)
        if now == size:
            break
        size = now
    roots = links.select(F.col("y").alias("node")).distinct()
    return links.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _size(links: DataFrame) -> tuple:
    """Changes whenever the links do: their number, and a sum of their hashes."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
