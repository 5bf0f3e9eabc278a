"""Connected components of a graph that is held as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stage


def star_edges(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions over the links
    ``left[i] - right[i]``: n labels say what any number of links within a block say."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (columns ``a``, ``b``, long) that
    is not the smallest of its component; component is that smallest node.

    Alternates large-star and small-star steps until the edges form stars, in a
    number of rounds that grows with the logarithm of the graph. Each round is a
    table in the shared folder; the driver sees a count and a checksum of it. The
    minima are tables as well, so that adaptive execution may split the partition
    of a node with very many edges. NULL ends and loops are no edges; an empty
    table gives an empty result.
    """
    edges = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a != b")
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        low = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = stage(
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")))
        pairs = F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = stage(
            large.join(low, "a").select(F.explode(pairs).alias("e")).select("e.a", "e.b").where("a != b").distinct()
        )
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _state(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
