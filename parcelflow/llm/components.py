"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every neighbour of a node on the smallest node it knows. A round is two joins and
two aggregations over the edges; a node with very many neighbours is combined before the shuffle on
the aggregated side and split by adaptive execution on the joined side, and no neighbour list is
ever built. The number of rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.common import stored


def _hang(pairs: DataFrame) -> DataFrame:
    """(u, v) rows with the smallest node among u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hang(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    hung = _hang(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    centre = hung.select("u", F.col("m").alias("v"))
    rest = hung.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return centre.unionByName(rest).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    ``edges`` has two whole-number columns u and v. Rows with a null or with u = v are no edges;
    repeated rows and both directions are allowed; an empty table gives an empty one.
    """
    edges = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges that one task holds: each node once, beside its smallest node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    ends = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[ends[0]], root[ends[1]])
        new = root.copy()
        for side in ends:
            np.minimum.at(new, root[side], low)
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]
