"""Connected components of a graph of integer ids, by contraction.

Each round hooks every node to its smallest neighbour (one aggregate with
map-side combine), renames edges and labels by that map, and drops edges
within a node.  At least half of the nodes that have edges go in each round; a
star of any size goes in one.  All joins are between scans, so that Spark can
split a hot centre.  Nothing is collected but the number of edges left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import materialize


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) for each id of ``nodes``: the smallest id reachable by
    the edges (a, b), itself included.  Ends of edges must be nodes."""
    edges = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = nodes.select("id", F.col("id").alias("component"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        hooks = materialize(hooks.select("node", F.least("node", "least").alias("to")), "hooks")
        labels = labels.join(hooks, F.col("component") == F.col("node"), "left").select("id", F.coalesce("to", "component").alias("component"))
        labels = materialize(labels, "labels")
        left, right = hooks.toDF("a", "x"), hooks.toDF("b", "y")
        renamed = edges.join(left, "a").select("x", "b").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = materialize(renamed.filter("a <> b").distinct(), "edges")
    return labels
