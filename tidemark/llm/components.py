"""Connected components of a distributed link table by alternating star contraction."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import salted_join, saved


def unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the groups of a[i] and b[i]; ``labels`` holds each member's smallest fellow."""
    a, b = labels[a], labels[b]
    while True:
        apart = a != b
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels = shorter
        a, b = labels[a], labels[b]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link to a smaller component member.

    ``links`` has two columns of one sortable type. The root is the smallest
    node of the component and has no row itself. Each round keeps the links'
    components and writes its links to the shared folder; the loop ends when a
    round changes nothing, after a number of rounds that grows with the
    logarithm of the longest path.
    """
    u, v = links.columns
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u != v").distinct()
    edges, before = saved(edges, "links"), None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31)), F.sum(F.xxhash64("v", "u") % (1 << 31))).first()
        if tuple(state) == before:
            return edges.toDF("node", "root")
        before = tuple(state)
        edges = saved(small_star(large_star(edges)), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def large_star(edges: DataFrame) -> DataFrame:
    """Link a node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return salted_join(both.where("v > u"), least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = salted_join(edges, least, "u", "v").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.toDF("u", "v").unionAll(moved).distinct()
