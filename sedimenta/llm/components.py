"""Connected components by joins: smallest labels spread over links, then labels of labels shorten the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage_lean


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (a, b); duplicates and loops do no harm.

    Each round every node links to the smallest node it knows of, and the graph shrinks to one link per node where a
    component is settled; the rounds grow with the logarithm of a component's width.
    """
    both = links.select("a", "b").where("a <> b")
    edges = stage_lean(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage_lean(
        edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        better = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        hop = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = stage_lean(better.join(hop, "component", "left").select(
            "node", "before", F.coalesce(F.least("component", "further"), "component").alias("component")), "labels")
        changed = new.where("before <> component").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
