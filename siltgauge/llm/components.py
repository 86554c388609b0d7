"""Connected components of a graph given by its edges, with joins and sums only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, landed


def _jumped(parents: DataFrame) -> DataFrame:
    """Every node with the root of its tree: parents of parents until none changes."""
    while True:
        above = parents.select(F.col("node").alias("_up"), F.col("parent").alias("_root"))
        step = parents.join(above, F.col("parent") == F.col("_up")).select("node", F.col("_root").alias("parent"), (F.col("_root") != F.col("parent")).alias("moved"))
        step = landed(step, "jump")
        discard(parents)
        parents = step.drop("moved")
        if step.where("moved").isEmpty():
            return parents


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: every node of ``edges`` with the smallest node it is connected to.

    Union-find by rounds over the whole table: every node takes its smallest neighbour as parent if that
    is smaller, the trees this makes are flattened by pointer jumping, each becomes one node, and the
    edges between them go into the next round, until there are none. A round leaves at most half of the
    nodes that still have edges. Minimums combine before the shuffle, and the joins are plain equi-joins
    of landed tables with a table of one row per node, which Spark splits where a node has many edges.
    Edges with NULL are left out, loops and repeated edges are harmless, no edges give an empty table.
    """
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.col(a).isNull() | F.col(b).isNull())
    pairs = landed(pairs.toDF("a", "b", "_null").where("a != b and not _null").drop("_null").distinct(), "edges")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = landed(nodes.select("node", F.col("node").alias("component")), "labels")
    while not pairs.isEmpty():
        both = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("_e"))
        smallest = both.groupBy(F.col("_e.a").alias("node")).agg(F.min("_e.b").alias("_min"))
        parents = _jumped(landed(smallest.select("node", F.least("node", "_min").alias("parent")), "parents"))

        def at(side: str, parents: DataFrame = parents) -> DataFrame:
            return parents.select(F.col("node").alias(side), F.col("parent").alias(f"_{side}"))

        merged = pairs.join(at("a"), "a").join(at("b"), "b").where("_a != _b")
        merged = landed(merged.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
        moved = labels.join(at("component"), "component", "left")
        moved = landed(moved.select("node", F.coalesce("_component", "component").alias("component")), "labels")
        for old in (pairs, labels, parents):
            discard(old)
        pairs, labels = merged, moved
    discard(pairs)
    return labels
