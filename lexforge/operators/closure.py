"""Everything that is reached along directed edges, such as the components of components of a symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.joins import lookup_join
from lexforge.operators.materialize import materialize


def closure(edges: DataFrame, source: str, target: str, depth: str = "depth", most: int | None = None) -> DataFrame:
    """(source, target, depth): every pair of which the second is reached from the first, with the fewest steps.

    Each round joins only the pairs that the round before found first (the frontier, a written table) to the edges, and keeps those that no round found yet. So a cycle ends by itself, a node
    of it reaches itself, and a pair found again in more steps is not followed. Rounds end when nothing is new, or after ``most`` steps. Edges that are sent to
    the tasks are measured, and a node that very many others reach is salted. Edges with a null end and repeated ones don't count.
    """
    known_edges = edges.select(F.col(source).alias("_from"), F.col(target).alias("_to")).filter("_from is not null and _to is not null").distinct()
    known_edges = materialize(known_edges, "edges")
    steps = known_edges.toDF("_via", "_next")
    found = [materialize(known_edges.withColumn("_depth", F.lit(1)), "frontier")]
    while most is None or len(found) < most:
        ahead = found[-1].select("_from", F.col("_to").alias("_via"))
        reached = lookup_join(ahead, steps, ["_via"], "inner").select("_from", F.col("_next").alias("_to")).distinct()
        for before in found:
            reached = reached.join(before.select("_from", "_to"), ["_from", "_to"], "left_anti")
        new = materialize(reached.withColumn("_depth", F.lit(len(found) + 1)), "frontier")
        if new.isEmpty():
            break
        found.append(new)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.toDF(source, target, depth)


def carried(items: DataFrame, item: str, node: str, edges: DataFrame, source: str, target: str, values: DataFrame, value: str,
            summaries: Sequence[Column], most: int | None = None) -> DataFrame:
    """(item, summaries...): aggregates of ``value`` over the nodes of each item and all that these reach, each node once.

    ``items`` holds (item, node) and ``values`` (node, value); the aggregates name the value's column. An item none of whose nodes has a value keeps a row of nulls and zeros.
    """
    own = materialize(items.select(F.col(item).alias("_item"), F.col(node).alias("_node")).distinct(), "own")
    reached = closure(edges, source, target, most=most).select(F.col(source).alias("_node"), F.col(target).alias("_reached"))
    below = lookup_join(own, materialize(reached, "reached"), ["_node"], "inner").select("_item", F.col("_reached").alias("_node"))
    nodes = materialize(own.union(below).distinct(), "nodes")
    valued = lookup_join(nodes, values.select(F.col(node).alias("_node"), F.col(value).alias(value)), ["_node"])
    return valued.groupBy(F.col("_item").alias(item)).agg(*summaries)
