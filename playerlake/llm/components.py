"""Connected components of a distributed edge list by repeated contraction.

Each round points every node at its smallest neighbour and rewrites the edges
through that pointer; what stays apart is contracted again. Every round is
written to the shared scratch folder, which cuts lineage and survives a lost
executor. The driver only sees whether edges are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlake.llm.storage import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b); component is its smallest node."""
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        # larger nodes point at their smallest neighbour, so pointers never cycle
        pointers = saved(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")), "pointers")
        rounds.append(pointers)
        by_a = pointers.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        by_b = pointers.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = edges.join(by_a, "a").join(by_b, "b", "left").select(F.col("to_a").alias("x"), F.coalesce("to_b", "b").alias("y"))
        edges = saved(moved.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    labels = None
    for pointers in reversed(rounds):
        if labels is None:
            labels = pointers.select("node", F.col("to").alias("component"))
        else:
            further = labels.select(F.col("node").alias("to"), F.col("component").alias("end"))
            stepped = pointers.join(further, "to", "left").select("node", F.coalesce("end", "to").alias("component"))
            # a pointer's target may point again in a later round: such a node keeps one row
            labels = saved(stepped.unionByName(labels.join(pointers, "node", "left_anti")), "labels")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = labels.select(F.col("component").alias("node"), "component").distinct()
    return labels.unionByName(roots)
