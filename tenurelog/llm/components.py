"""Connected components of an edge table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .workspace import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``, a written table; root is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so a chain halves; it ends when a round changes nothing. All
    state lies in written tables, and only one number per round comes back.
    Partial minima are taken before each shuffle, so a node with very many
    edges does not meet in one task as rows.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    labels = work.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "root")
        # A node's own label goes the same way as its neighbours', so one exchange serves both.
        own = labels.select("node", "root", F.col("root").alias("was"))
        step = near.unionByName(own, allowMissingColumns=True).groupBy("node").agg(F.min("root").alias("low"), F.max("was").alias("was"))
        far = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        jumped = step.join(far, "low").select("node", F.least("low", "far").alias("root"), "was")
        seen = Observation()
        changed = jumped.observe(seen, F.count_if(F.col("root") != F.col("was")).alias("n")).select("node", "root")
        before, labels = labels, work.write(changed, "labels")
        work.drop(before)
        if not seen.get.get("n"):  # nothing is observed where Spark finds the table empty
            return labels
