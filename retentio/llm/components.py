"""Connected components of a link table, by the smallest node reached."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.plans.tables import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node`, `label` (smallest node of its component) for every node that
    has a link. Each round takes the smallest label among the neighbours and
    then the label of that label, until no label changes; rounds are written
    as tables, so a lost executor reads files again. Minima are taken before
    each shuffle, so a node with very many links is one row per task."""
    both = materialize(
        links.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .union(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
        .filter(F.col("node") != F.col("other")), "links")
    labels = materialize(
        both.groupBy("node").agg(F.min("other").alias("m"))
        .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        spread = (both.join(labels.withColumnRenamed("node", "other"), "other")
                  .groupBy("node").agg(F.min("label").alias("m")))
        nearer = (labels.join(spread, "node")
                  .select("node", F.col("label").alias("was"), F.least("label", "m").alias("near")))
        hop = labels.select(F.col("node").alias("near"), F.col("label").alias("hop"))
        labels = materialize(
            nearer.join(hop, "near").select("node", "was", F.least("near", "hop").alias("label")),
            "labels")
        changed = labels.filter(F.col("label") != F.col("was")).limit(1).count()
        labels = labels.drop("was")
        if not changed:
            return labels
