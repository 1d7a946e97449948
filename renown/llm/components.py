"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``component``: the smallest node that links lead to.

    Each round a node takes the smallest label among its neighbours and then the label of
    its label, so the distance covered doubles; labels are written every round. Nodes without
    links do not appear. A node with very many links is summed in parts before it is shuffled.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(F.col(a).alias("node"), F.col(b).alias("other"))
        .union(links.where(F.col(a) != F.col(b)).select(F.col(b), F.col(a))).distinct(),
        "component-edges",
    )
    labels = stage(
        edges.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("component")),
        "component-labels",
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node").agg(F.min("component").alias("near"))
        )
        moved = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("jumped"))
        after = stage(
            moved.join(jump, "component", "left")
            .select("node", "old", F.least("component", F.coalesce("jumped", "component")).alias("component")),
            "component-labels",
        )
        if after.where(F.col("old") != F.col("component")).isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
