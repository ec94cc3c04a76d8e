"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Edges are kept as (hi, lo) with hi > lo. Both steps need the least neighbour of a node: a ``min`` that
combines on the map side, then a join in which the edge side may hold a hub many times and the other
side holds each node once, so AQE can split the hub. Every round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.session import cut_lineage


def _oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    x, y = F.col(a), F.col(b)
    return edges.where(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct()


def _least_neighbour(edges: DataFrame, name: str) -> DataFrame:
    return edges.groupBy(F.col("hi").alias(name)).agg(F.min("lo").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    least = _least_neighbour(edges, "node")
    moved = edges.join(least, edges["lo"] == least["node"], "left")
    return moved.select("hi", F.coalesce("least", "lo").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least_neighbour(edges, "node")
    seen = edges.join(least, edges["hi"] == least["node"]).select("hi", "lo", "least")
    ends = seen.select(
        F.explode(F.array("hi", "lo")).alias("hi"), F.col("least").alias("lo")
    )
    return ends.where(F.col("hi") != F.col("lo")).distinct()


def _signature(edges: DataFrame):
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def component_edges(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(hi, lo): each node that is not the least of its component, with that least node."""
    current = cut_lineage(_oriented(edges, a, b))
    before = _signature(current)
    while before[0]:  # every round lowers an edge or ends
        current = cut_lineage(_small_star(_large_star(current)))
        after = _signature(current)
        if after == before:
            return current
        before = after
    return current


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node", a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the component is named by its least node."""
    stars = component_edges(edges, a, b)
    return nodes.join(stars.withColumnRenamed("hi", node), node, "left").select(
        node, F.coalesce("lo", node).alias("component")
    )
