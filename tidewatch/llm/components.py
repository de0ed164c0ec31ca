"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is one join and one aggregation on node ids, so a hub with a third of
all edges is a skewed join key that adaptive execution splits and a combinable
minimum; no neighbour list is ever collected.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b) with a > b: link neighbours to the smallest of them."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a long, b long)``; the root is the component's smallest node.

    Loops, repeated and reversed edges are fine; edges with a null end link nothing;
    no edges give no rows.  Each round is checkpointed to the shared folder, and the
    rounds grow with the logarithm of the longest chain.
    """
    state = (edges.where("a is not null and b is not null and a != b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # the two pairwise xor sums tell a changed edge set from the same one
    print_of = lambda df: df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    state = checkpointed(state)
    before = print_of(state)
    while before.n:
        state = checkpointed(_star(_star(state, True), False))
        after = print_of(state)
        if after == before:
            break
        before = after
    members = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges ``(member, smallest member)`` of the graph of the given edges, vectorised.

    Used inside a task to send at most one edge a member onwards, however many
    links there are.
    """
    if not len(a):
        return a[:0], b[:0]
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:                                        # point every node at its root
            up = new[new]
            if np.array_equal(up, new):
                break
            new = up
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
