"""Connected components of a link table, without ever holding a component in one place."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed


HOT_LINKS, MOST_HOT = 50_000, 100_000  # links of a node that is joined by broadcast, at least; such nodes, at most


def _beside_smallest(pairs: DataFrame, smallest: DataFrame, rows: int, hot_links: int) -> DataFrame:
    """``pairs(u, v)`` with ``m`` of ``smallest(u, m, n)``, where ``n`` is how many of the ``rows`` pairs have ``u``.

    The rows of a node with very many links stay where they are: ``rows / limit`` nodes at most can have more than ``limit``
    links, and so few are broadcast.  All others are joined by their node.
    """
    limit = max(hot_links, -(-rows // MOST_HOT))
    if rows <= limit:
        return pairs.join(smallest.select("u", "m"), "u")
    hot = F.broadcast(smallest.where(F.col("n") > limit).select("u", "m"))
    others = pairs.join(hot, "u", "left_anti").join(smallest.where(F.col("n") <= limit).select("u", "m"), "u")
    return pairs.join(hot, "u").select("u", "v", "m").unionByName(others.select("u", "v", "m"))


def components(links: DataFrame, hot_links: int = HOT_LINKS) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; ``root`` is the smallest node of its component.

    Large-star and small-star steps by turns: each node's larger, then its smaller, neighbours are linked to its smallest
    one, until nothing changes.  Rounds grow with the logarithm of the longest path.  Every step is an aggregation with
    map-side combine and a join that leaves the links of a giant component's nodes where they are; each round is checkpointed.
    Self-links, repeated links and links with null ends are allowed; null ends are ignored.
    """
    edges = (
        links.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = checkpointed(edges)
    seen, rows = None, 2 * edges.count()
    while True:
        both = edges.union(edges.select("v", "u"))
        smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = _beside_smallest(both, smallest, rows, hot_links).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _beside_smallest(large, smallest, rows, hot_links)
        edges = checkpointed(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        # exact sums over all edges, wide enough not to overflow: a step that changes nothing keeps them
        state = edges.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen, rows = tuple(state), 2 * state[0]
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index per node of a small graph of ``n`` nodes, by label passing with pointer jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
