"""Connected components of a link table by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (a, b: bigint, not null).

    Each round a node takes the smallest label among itself and its neighbours, then the
    label of its label; labels are written each round, so a lost executor costs one round.
    A node with very many neighbours is pre-aggregated before the shuffle. No links: no rows.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = materialize(labels)
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label")
        least = labels.withColumn("own", F.col("label")).unionByName(heard, allowMissingColumns=True).groupBy("node").agg(
            F.min("label").alias("label"), F.max("own").alias("own"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = materialize(least.join(up, "label", "left").select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "own"))
        if labels.where("label <> own").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
