"""Connected components by contraction, for graphs that no task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of the undirected ``edges`` (a, b), the smallest node that it reaches.

    Each round points every node at its smallest neighbour (or itself), follows
    the pointers twice, and replaces the edges' ends by what they point at. The
    smallest node of a component never points away, so it is what is left of
    it. A star ends after one round; a chain of n nodes after log n. Every
    round's tables are written to the shared folder. Loops and repeated edges
    do no harm; null ends are ignored; no edges give no rows.
    """
    edges = stage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while True:
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        to = stage(near.select("node", F.least("node", "low").alias("to")), "pointers")
        for _ in range(2):
            to = to.join(to.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to"))
        to = stage(to, "pointers")
        if labels is None:
            labels = to.select("node", F.col("to").alias("component"))
        else:
            step = to.select(F.col("node").alias("component"), "to")
            labels = stage(labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        left = to.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = to.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        edges = stage(edges.join(left, "a").join(right, "b").filter("to_a <> to_b")
                      .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
