"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.runtime import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges; the component is the smallest node in it.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, and writes the
    labels to the shared folder; rounds grow with the logarithm of the longest path. Loops and repeated edges do no
    harm; no edges give no rows; an edge with a NULL end counts for nothing. A hot node costs one pre-aggregated group.
    """
    clean = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    both = cut(clean.unionByName(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "label": "other"}), "b").groupBy("a").agg(F.min("other").alias("other"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "other").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        after = cut(step.join(jump, "new", "left").select("node", "label", F.least("new", "far").alias("new")))
        if after.where("new <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
        labels = after.select("node", F.col("new").alias("label"))
