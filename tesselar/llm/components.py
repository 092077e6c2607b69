"""Connected components of an edge table by contraction: every round replaces each node by its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.workspace import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node of it) for the nodes of ``edges`` (columns ``u``, ``v``).

    Null ends and loops are ignored. Every round is written to the shared folder; the number of nodes with an
    edge at least halves in each, as every such node joins a neighbour.
    """
    edges = edges.where(F.col("u") != F.col("v")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = materialize(edges.distinct(), "component-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Each node points to the smallest of itself and its neighbours: never to a larger node, so no cycles.
        step = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        step = materialize(step, "component-step")
        if labels is None:
            labels = step.select(F.col("u").alias("node"), F.col("m").alias("component"))
        else:
            moved = step.select(F.col("u").alias("component"), "m")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("m", "component").alias("component"))
        labels = materialize(labels, "component-labels")
        edges = edges.join(step.withColumnRenamed("m", "mu"), "u").select("mu", "v")
        edges = edges.join(step.select(F.col("u").alias("v"), F.col("m").alias("mv")), "v").select("mu", "mv")
        edges = edges.where(F.col("mu") != F.col("mv")).select(F.least("mu", "mv").alias("u"), F.greatest("mu", "mv").alias("v"))
        edges = materialize(edges.distinct(), "component-edges")
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
