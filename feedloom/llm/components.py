"""Connected components of a graph given by its links, by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its component) that connect what the links a-b connect: fewer
    than there are nodes, however many links there are."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        open_ = x != y
        if not open_.any():
            break
        left, right, x, y = left[open_], right[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    inner = root != np.arange(len(nodes))
    return nodes[inner], nodes[root[inner]]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the least node that it reaches) for every node that has a link to
    another node.

    Each round hangs every node's larger neighbours, then its smaller ones, on the least of them;
    the number of rounds follows the logarithm of the longest chain. A hot node's links are
    pre-aggregated for the least neighbour and its join partition is one that Spark can split.
    Rounds are stored, so their lineage stays short. An empty graph gives an empty table.
    """
    edges = links.where(f"{a} <> {b}").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, state = measured(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        # After this every row's u is larger than its v, so a node's rows name its smaller ones.
        smaller = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smaller, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, after = measured(small.unionByName(smaller.select("u", F.col("m").alias("v"))).distinct())
        if after == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after


def measured(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = stored(edges)
    return edges, tuple(edges.selectExpr(
        "count(*)", "bit_xor(xxhash64(u, v))", "bit_xor(xxhash64(v, u, 1))").head())
