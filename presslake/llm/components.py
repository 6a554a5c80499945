"""Connected components of a table of links, without collecting links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from presslake.sources.workspace import materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in the undirected links ``a, b``; a component is named by its smallest id.

    Each round takes the smallest label among an id's neighbours, then the label of that label, so long chains
    shrink by doubling. A round is written to the shared folder, which cuts the plan and survives lost executors.
    """
    ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    edges = materialize(ways.distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", F.least("component", "near").alias("lower"), F.col("component").alias("old"))
        jump = lower.alias("x").join(lower.select(F.col("id").alias("to"), F.col("lower").alias("far")).alias("y"), F.col("x.lower") == F.col("y.to"))
        after = materialize(jump.select("x.id", F.least("x.lower", "y.far").alias("component"), "x.old"), "labels")
        labels = after.select("id", "component")
        if after.filter("component <> old").isEmpty():
            return labels
