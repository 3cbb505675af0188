"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def forest(edges: np.ndarray) -> np.ndarray:
    """Edges ``(n, 2)`` -> one edge from every node to the smallest of its component (inside one task)."""
    if not len(edges):
        return edges
    nodes, flat = np.unique(edges, return_inverse=True)
    flat = flat.reshape(edges.shape)
    root = np.arange(len(nodes))
    while True:
        a, b = root[flat[:, 0]], root[flat[:, 1]]
        open_ = a != b
        if not open_.any():
            break
        low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
        np.minimum.at(root, high, low)
        while True:                                   # pointer jumping
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack((nodes[root[child]], nodes[child]), axis=1)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` that isn't its component's root.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest neighbour; the
    number of rounds grows with the logarithm of the longest path. Only minima are aggregated (combined
    map-side), no neighbour list is built. Minima are stored before their edges are joined with them: both sides
    of a join are then plain tables, so Spark can broadcast the minima where they are few and otherwise split
    the edges of a star's hub over several tasks. Every round is stored in the shared folder.
    """
    now = stored(edges.filter(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components-edges")
    seen = _state(now)
    while seen[0]:
        both = now.union(now.select("v", "u"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-low")
        large = stored(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "components-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        small = large.join(least, "u")
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        now = stored(small.distinct(), "components-edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal states are equal edge sets."""
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
                  F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
    return r["n"], r["s"], r["x"]
