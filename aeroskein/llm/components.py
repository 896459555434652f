"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (columns a, b); component is the smallest node reachable.

    Each round takes the smallest label among the neighbours, then follows the label of the
    label, so that chains shorten by halves, until no label falls. Sums and minima are combined before they are
    shuffled; no neighbour list is ever gathered. Every round is a written table.
    Null ends and self loops are dropped; no edges give no rows.
    """
    clean = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = staged(
        clean.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .union(clean.select(F.col("b").alias("src"), F.col("a").alias("dst"))).distinct(),
        "edges",
    )
    labels = staged(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m"))
                    .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("dst"), "component"), "dst")
            .groupBy(F.col("src").alias("node")).agg(F.min("component").alias("m"))
        )
        lower = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "m").alias("component"))
        lower = staged(lower, "labels")
        parent = lower.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = staged(
            lower.join(parent, "component").select("node", "was", F.least("component", "up").alias("component")), "labels"
        )
        changed = jumped.where(F.col("was") != F.col("component")).limit(1).count()
        labels = jumped.select("node", "component")
        if not changed:
            return labels
