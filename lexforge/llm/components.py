"""Connected components of links as joins, without gathering links or labels anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.operators.materialize import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b): the smallest node reachable. Nodes without links don't appear.

    Every round takes the smallest label among a node's neighbours and then the label of that label, so paths shorten
    by half or more; rounds end when no label changes. A node with many links is split by the adaptive joins, and minima
    are combined before each shuffle.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    edges = materialize(both.toDF("node", "near").filter("node <> near").distinct(), "edges")
    labels = materialize(edges.groupBy("node").agg(F.min("near").alias("_m")).select("node", F.least("node", "_m").alias("component")), "labels")
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("component").alias("_heard"))
        nearer = materialize(labels.join(heard, "node").select("node", "component", F.least("component", "_heard").alias("_next")), "nearer")
        # the label's own label; a label is a node, so it is in the table
        of = nearer.select(F.col("node").alias("_next"), F.col("_next").alias("_jump"))
        moved = nearer.join(of, "_next").select("node", F.col("component").alias("_old"), F.least("_next", "_jump").alias("component"))
        moved = materialize(moved, "labels")
        labels = moved.select("node", "component")
        if not moved.filter("_old <> component").limit(1).count():
            return labels
