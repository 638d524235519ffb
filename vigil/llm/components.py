"""Connected components of an edge list, by alternating star contraction in Spark joins.

Helper of the near-duplicate operators. Every round only moves rows keyed by
node; the smallest neighbour of a node is a partial aggregate, so a node with
a third of all edges is one row a task, and the join on it is one that
adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("_m")).select(
        F.col("u").alias("_u"), F.least("u", "_m").alias("m"))
    return both.filter("v > u").join(low, F.col("u") == F.col("_u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours and itself are linked to the smallest of them (edges go from large to small)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    hop = edges.join(low.select(F.col("u").alias("_u"), "m"), F.col("u") == F.col("_u")).filter("v > m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).union(hop).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, v) links -> (node, root): the smallest node reachable, for every node that is not the smallest itself.

    Self links and repeated links are ignored. Rounds go on until nothing
    changes; each is written to the shared folder, so a lost executor repeats
    part of one round at most.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    links = stored(links, f"{name}-links")
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), f"{name}-round")
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(links: DataFrame) -> tuple[int, int]:
    """Number and checksum of the links: equal only when a round changed nothing."""
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1] or 0


def spanning_links(n: int, pairs: Iterator[np.ndarray]) -> tuple[list[int], list[int]]:
    """Of the links between ``n`` items, those that join two parts not yet joined."""
    parent = np.arange(n)
    us: list[int] = []
    vs: list[int] = []
    for block in pairs:
        while (up := parent[parent] != parent).any():
            parent[up] = parent[parent[up]]
        block = block[parent[block[:, 0]] != parent[block[:, 1]]]
        up = {}

        def find(i: int, up: dict[int, int] = up) -> int:
            while (j := up.get(i, i)) != i:
                up[i] = i = up.get(j, j)
            return i

        for (i, j), (p, q) in zip(block.tolist(), parent[block].tolist(), strict=True):
            p, q = find(p), find(q)
            if p != q:
                up[max(p, q)] = min(p, q)
                us.append(i)
                vs.append(j)
        for p, q in up.items():
            parent[p] = q
    return us, vs
