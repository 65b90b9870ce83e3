"""Connected components of a link table, without collecting links or components.

Alternating large-star / small-star rounds (min-label contraction with pointer
jumping): after every round each node points to a smaller member of its
component and the rounds end when every component is one star around its
smallest node.  Each round is an aggregation (partial map-side, so a hub costs
one row per task) and an inner equi-join.  The aggregated side is materialised
first: joined straight from its aggregation it would pin the join to one
partition per hub, while from a table it is broadcast if small, and else both
sides are exchanged and AQE splits a hot hub.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction step on edges (u, v): connect neighbours to the smallest node around ``u``."""
    if large:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        j = both.join(m, "u").filter(F.col("v") > F.col("u"))
        return j.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = cut(down.groupBy("u").agg(F.min("v").alias("m")))
    j = down.join(m, "u")
    return (j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(m.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link; component = smallest reachable node.

    Nodes without links do not appear.  Self-links, repeated and reversed links
    are harmless; null ends are ignored; no links give an empty result.
    """
    edges = cut(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                .filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    n, s = _digest(edges)
    while n:
        edges = cut(_star(_star(edges, large=True), large=False))
        n2, s2 = _digest(edges)
        if (n, s) == (n2, s2):
            break
        n, s = n2, s2
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Row count and order-free checksum of the edge set: equal before and after a round at the fixed point."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def spanning_links(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within one task: replace index pairs on 0..n-1 by (member, smallest member of its linked set)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]
