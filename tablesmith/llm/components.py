"""Connected components of an edge table, on Spark: labels spread along edges and through labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import saved, saved_measured


def connected(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), for each node that has an edge.

    Each round takes the least label among a node and its neighbours, then the
    label of that label, so chains shorten by half a round; a hub's neighbours
    are reduced by partial aggregates. Every round is a written table. ``rows``:
    a bound of the edges, if one was measured.
    """
    double = None if rows is None else 2 * rows
    edges = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", double)
    labels = saved(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("label")), "labels", double)
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("label").alias("near"))
        least = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumped = least.join(labels.select(F.col("node").alias("label"), F.col("label").alias("further")), "label") \
            .select("node", "old", F.least("label", "further").alias("label"))
        new, _, changed = saved_measured(jumped, "labels", (F.col("label") != F.col("old")).cast("long"), double)
        labels = new.select("node", "label")
        if not changed:
            return labels
