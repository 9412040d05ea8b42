"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, label) for every id of edges (a, b, both long); label: the smallest id reachable.

    Each round takes the smallest label among an id's neighbours, then the label of that label, and writes what it has to the shared folder; it ends when no label changes. A hub with very many neighbours is one group of a minimum, which is taken before the shuffle."""
    both = scratch.table(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), f"{name}-edges")
    labels = scratch.table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("label")), f"{name}-0")
    n = 0
    while True:
        n += 1
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.least("label", "near").alias("to"), F.col("label").alias("old"))
        step = scratch.table(step, f"{name}-step{n}")
        jump = step.select(F.col("id").alias("at"), F.col("to").alias("next"))
        new = scratch.table(step.join(jump, step["to"] == jump["at"], "left").select("id", F.least("to", F.coalesce("next", "to")).alias("label"), "old"), f"{name}-{n}")
        scratch.drop(f"{name}-{n - 1}")
        scratch.drop(f"{name}-step{n}")
        done = new.where("label <> old").isEmpty()
        labels = new.select("id", "label")
        if done:
            return labels
