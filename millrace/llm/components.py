"""Connected components of links, by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def jumped(parents: DataFrame) -> DataFrame:
    """(node, parent) with every parent a root; each parent is smaller than its node or the node itself."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        step = parents.join(above, "parent", "left").select(
            "node", F.coalesce("grand", "parent").alias("parent"), (F.col("grand") < F.col("parent")).alias("moved")
        )
        step = written(step, "components-jump")
        parents = step.select("node", "parent")
        if step.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node that can be reached.

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots, and goes
    on with the links between different roots.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "components-edges")
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b"))
        roots = jumped(written(hooks.select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "components-hooks"))
        if found is None:
            found = roots.withColumnRenamed("parent", "component")
        else:
            above = roots.select(F.col("node").alias("component"), F.col("parent").alias("root"))
            found = found.join(above, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        found = written(found, "components-found")
        left = roots.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = roots.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        edges = edges.join(left, "a").join(right, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        edges = written(edges.distinct(), "components-edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
