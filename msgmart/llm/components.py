"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgmart.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """node, component (its least node) for every node of the edges (a, b).

    Each round every node takes the least label around it, then the label of its label, so chains
    shorten by more than half a round. Labels are reduced per task before they are shuffled, and
    joins have a node's edges on one side only, so that a node of very many edges can be split.
    """
    both = scratch.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b"), f"{name}-edges")
    labels = scratch.keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), f"{name}-0")
    done, k = False, 0
    while not done:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = low.join(up, "label").select("node", "old", F.least("label", "further").alias("label"))
        new = scratch.keep(new, f"{name}-{k + 1}")
        done = new.where("label != old").isEmpty()
        scratch.drop(f"{name}-{k}")
        labels, k = new.select("node", "label"), k + 1
    return labels.select("node", F.col("label").alias("component"))
