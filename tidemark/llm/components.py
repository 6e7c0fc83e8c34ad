"""Connected components by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (long columns a, b): the
    component is its smallest node.

    A label is always a node of the same component. Each round takes the smallest
    label among a node's neighbours (a minimum, combined before the shuffle, so hubs
    get no list). The smallest of these among all nodes of one label moves the
    whole label (hooking), and then each label takes the label of its label (a
    jump). When a round changes nothing, all ends of links agree, and on their
    smallest node. Labels hook in trees whose depth the jumps halve, so the rounds
    grow with the logarithm of the longest path, whatever the order of its ids;
    stars need one, and one to see it."""
    both = checkpointed(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = checkpointed(both.groupBy(F.col("a").alias("node"))
                          .agg(F.min("b").alias("near"))
                          .select("node", F.least("node", "near").alias("component")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        lower = checkpointed(labels.join(near, "node")
                             .select("node", F.col("component").alias("was"),
                                     F.least("component", "near").alias("near")))
        hooked = lower.groupBy("was").agg(F.min("near").alias("up"))
        moved = checkpointed(lower.join(hooked, "was").select("node", "was", "up"))
        heads = moved.select(F.col("node").alias("up"), F.col("up").alias("head"))
        after = checkpointed(moved.join(heads, "up")
                             .select("node", "was", F.least("up", "head").alias("component")))
        labels = after.select("node", "component")
        if after.filter("was <> component").isEmpty():
            return labels
