"""Connected components in which given pairs must not meet.

Edges are joined in descending confidence (ties by their ends), and an edge that would put a forbidden pair into one component is
refused; so a forbidden pair is parted where the evidence between the two is weakest, and no third node brings it together again.
With one forbidden pair in a component, the result is its two parts.

Only components that hold a forbidden pair are worked on edge by edge. There, a node with a single edge that is in no
forbidden pair follows its neighbour whatever happens, so it is set aside first: of a shared mailbox or phone with very many
records, what is left is its representative. The rest of a component streams in order through one task, which keeps one entry
per node that has several edges or is forbidden to meet another.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.operators.components import connected_components
from constituent360.session import cut_lineage


class Clusters:
    """Union-find with pairs that must stay apart."""

    def __init__(self):
        self.parent, self.enemies = {}, {}

    def find(self, x):
        self.parent.setdefault(x, x)
        root = x
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def part(self, a, b) -> None:
        for x, y in ((a, b), (b, a)):
            self.find(x)
            self.enemies.setdefault(x, []).append(y)

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return True
        few, many = sorted((a, b), key=lambda r: len(self.enemies.get(r, ())))
        if any(self.find(x) == many for x in self.enemies.get(few, ())):
            return False
        self.parent[few] = many
        if few in self.enemies:
            self.enemies.setdefault(many, []).extend(self.enemies.pop(few))
        return True


def _joined(work: DataFrame, kind: str) -> DataFrame:
    """(node, joined): a name of its own for every cluster, from (component, step, confidence, a, b); step 0 parts, step 1 joins."""
    in_order = work.repartition("component").sortWithinPartitions("component", "step", F.col("confidence").desc(), "a", "b")

    def run(batches):
        at, clusters = None, Clusters()

        def result():
            nodes = list(clusters.parent)
            return pa.RecordBatch.from_arrays([pa.array(nodes, arrow), pa.array([clusters.find(n) for n in nodes], arrow)], names=["node", "joined"])

        arrow = pa.string() if kind == "string" else pa.int64()
        for batch in batches:
            for component, step, a, b in zip(*[batch.column(c).to_pylist() for c in ("component", "step", "a", "b")]):
                if component != at:
                    if clusters.parent:
                        yield result()
                    at, clusters = component, Clusters()
                (clusters.join if step else clusters.part)(a, b)
        if clusters.parent:
            yield result()

    return in_order.select("component", "step", "a", "b").mapInArrow(run, f"node {kind}, joined {kind}")


def constrained_components(nodes: DataFrame, edges: DataFrame, forbidden: DataFrame, node: str = "node") -> DataFrame:
    """(node, component), the component named by its least node. ``edges``: a, b, confidence; ``forbidden``: a, b.

    Rows of ``forbidden`` with equal or null ends, or with ends that are no nodes, have no effect."""
    kind = nodes.schema[node].dataType.simpleString()
    edges, forbidden = cut_lineage(edges.where("a <> b").select("a", "b", "confidence")), forbidden.where("a <> b").select("a", "b")
    found = cut_lineage(connected_components(nodes.select(node), edges, node))
    of = lambda end: found.select(F.col(node).alias(end), "component")
    within = forbidden.join(of("a"), "a").join(of("b").withColumnRenamed("component", "_of_b"), "b").where(F.col("component") == F.col("_of_b"))
    within = cut_lineage(within.select("component", "a", "b").distinct())
    held = within.select("component").distinct()
    inside = edges.join(of("a"), "a").join(held, "component", "left_semi")
    inside = cut_lineage(inside.groupBy("component", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("confidence").alias("confidence")))
    ends = lambda df: df.select(F.explode(F.array("a", "b")).alias("end"))
    kept = ends(inside).groupBy("end").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("end").unionByName(ends(within)).distinct()
    kept = cut_lineage(kept)
    mark = lambda df, end: df.join(kept.select(F.col("end").alias(end), F.lit(True).alias(f"_{end}")), end, "left")
    marked = mark(mark(inside, "a"), "b").withColumns({f"_{c}": F.coalesce(f"_{c}", F.lit(False)) for c in "ab"})
    steps = marked.where("_a and _b").select("component", F.lit(1).alias("step"), "confidence", "a", "b").unionByName(
        within.select("component", F.lit(0).alias("step"), F.lit(0.0).alias("confidence"), "a", "b")
    )
    joined = cut_lineage(_joined(steps, kind))
    leaf = marked.where("_a <> _b").select(F.when(F.col("_a"), F.col("b")).otherwise(F.col("a")).alias("leaf"), F.when(F.col("_a"), F.col("a")).otherwise(F.col("b")).alias("node"))
    follow = leaf.join(joined, "node").select(F.col("leaf").alias("node"), "joined")
    parted = cut_lineage(joined.unionByName(follow))
    names = parted.groupBy("joined").agg(F.min("node").alias("least"))
    renamed = parted.join(names, "joined").select(F.col("node").alias(node), "least")
    return found.join(renamed, node, "left").select(node, F.coalesce("least", "component").alias("component"))
