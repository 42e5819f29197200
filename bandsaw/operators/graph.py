"""Connected components of edge tables: small graphs in groups, large ones by star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsaw.operators.bands import map_rows
from bandsaw.operators.kernels import smallest_index
from bandsaw.operators.skew import lookup
from bandsaw.session import cut_lineage

LOCAL_EDGES = 1 << 16


def _large_star(edges: DataFrame, key: str) -> DataFrame:
    both = edges.unionByName(edges.select(key, F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy(key, "u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = lookup(both, smallest, [key, "u"]).filter("v > u")
    return joined.select(key, F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, key: str) -> DataFrame:
    smallest = edges.groupBy(key, "u").agg(F.min("v").alias("m"))
    joined = lookup(edges, smallest, [key, "u"]).filter("v <> m")
    moved = joined.select(key, F.col("v").alias("u"), F.col("m").alias("v"))
    kept = smallest.select(key, "u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def star_components(edges: DataFrame, key: str = "image_id") -> DataFrame:
    """Components by star contraction, for graphs of any size.

    Rounds grow with the logarithm of the component size; each round is written
    to the shared folder, so a lost executor costs one round at most.
    """
    oriented = edges.select(key, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = cut_lineage(oriented.filter("u <> v").distinct())
    n = stars.count()
    while n:
        before, n_before = stars, n
        stars = cut_lineage(_small_star(_large_star(stars, key), key))
        n = stars.count()
        # both are sets, so they are equal if they are as large and none is new
        if n == n_before and stars.join(before, [key, "u", "v"], "left_anti").isEmpty():
            break
    leaves = stars.select(key, F.col("u").alias("node"), F.col("v").alias("root"))
    centres = stars.select(key, F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(centres)


def _group_components(edges: DataFrame, key: str) -> DataFrame:
    """Components of one small graph per key."""

    def label(row: dict) -> dict:
        nodes, ends = np.unique(np.array([row["u"], row["v"]]), return_inverse=True)
        ends = ends.reshape(2, -1)
        return {
            key: np.full(nodes.size, row[key], np.int64),
            "node": nodes,
            "root": nodes[smallest_index(nodes.size, ends[0], ends[1])],
        }

    graphs = edges.groupBy(key).agg(F.collect_list("u").alias("u"), F.collect_list("v").alias("v"))
    return map_rows(graphs, label, f"{key} bigint, node bigint, root bigint")


def connected_components(edges: DataFrame, key: str = "image_id", local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(key, node, root) for every node of ``edges`` (key, u, v); root is the smallest node.

    A key with at most ``local_edges`` edges is one bounded group; larger graphs
    go through star contraction.
    """
    edges = cut_lineage(edges.select(key, "u", "v"))
    sizes = edges.groupBy(key).agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > local_edges).select(key)
    if large.isEmpty():
        return _group_components(edges, key)
    large = cut_lineage(large)
    small = _group_components(edges.join(large, key, "left_anti"), key)
    return small.unionByName(star_components(edges.join(large, key, "left_semi"), key))
