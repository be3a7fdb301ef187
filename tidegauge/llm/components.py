"""Connected components of links by contraction: each round, nodes point to their smallest neighbour,
pointers are followed to their roots, and links between roots remain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import written


def _mapped(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """``column`` replaced by its parent, where it has one."""
    to = parent.select(F.col("node").alias(column), F.col("root").alias("__to"))
    out = df.join(to, column, "left")
    return out.withColumn(column, F.coalesce("__to", column)).drop("__to")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``links`` (a, b); root is the smallest node reachable. Links are
    only ever joined and aggregated, so neither a hot node nor a long chain meets in one task. Every node
    with a link points to a smaller one or is pointed at, so each round at least halves the nodes that
    still have links. Links of a node with itself and repeated links change nothing; without links there
    are no rows."""
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        # by name: a join on one of the columns may have put it first
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        parent = written(parent.withColumn("root", F.least("node", "root")), "parents")
        while True:
            jumped = written(_mapped(parent.withColumn("was", F.col("root")), "root", parent), "parents")
            done = jumped.where("root <> was").isEmpty()
            parent = jumped.drop("was")
            if done:
                break
        labels = parent if labels is None else written(_mapped(labels, "root", parent), "labels")
        edges = _mapped(_mapped(edges, "a", parent), "b", parent)
        edges = written(edges.where("a <> b").distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels.select("node", "root")
