"""Connected components by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, label) for each node of `edges` (x, y): label is the smallest node of its component.

    Each round maps every node to the smallest of itself and its neighbours, twice over, and carries the
    edges along; edges inside a node vanish. Edges and labels of a round are written, so lineage stays
    short; nothing but the count of edges left reaches the driver.
    """
    k = 0
    edges = scratch.keep(edges.select("x", "y").filter("x != y").distinct(), f"{name}-edges-0")
    nodes = edges.select(F.col("x").alias("node")).union(edges.select("y")).distinct()
    labels = scratch.keep(nodes.withColumn("label", F.col("node")), f"{name}-labels-0")
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        near = both.groupBy("x").agg(F.least("x", F.min("y")).alias("to"))
        next_ = near.select(F.col("x").alias("to"), F.col("to").alias("then"))
        step = scratch.keep(near.join(next_, "to", "left").select(F.col("x").alias("from"), F.coalesce("then", "to").alias("to")), f"{name}-step-{k}")
        moved = labels.join(step, labels["label"] == step["from"], "left").select("node", F.coalesce("to", "label").alias("label"))
        k += 1
        labels = scratch.keep(moved, f"{name}-labels-{k}")
        a, b = step.select(F.col("from").alias("x"), F.col("to").alias("p")), step.select(F.col("from").alias("y"), F.col("to").alias("q"))
        carried = edges.join(a, "x").join(b, "y").filter("p != q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct()
        edges = scratch.keep(carried, f"{name}-edges-{k}")
        scratch.drop(f"{name}-edges-{k - 1}", f"{name}-labels-{k - 1}", f"{name}-step-{k - 1}")
    return labels
