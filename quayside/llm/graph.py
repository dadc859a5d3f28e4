"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..settings import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: for every node of a link the smallest node it is connected with.

    Each round a node takes the smallest label among its neighbours, then the label of that label, so
    a chain of n nodes ends after about log n rounds.  Every round is stored, so a lost executor costs
    one round.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    edges = materialize(
        both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = materialize(
        edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("component").alias("seen"))
        lower = labels.join(seen, "node").select(
            "node", F.least("component", "seen").alias("next"), F.col("component").alias("was"))
        jump = lower.join(
            labels.select(F.col("node").alias("next"), F.col("component").alias("beyond")), "next", "left")
        step = materialize(
            jump.select("node", F.least("next", F.coalesce("beyond", "next")).alias("component"), "was"), "labels")
        labels = step.select("node", "component")
        if step.filter("component <> was").isEmpty():
            return labels
