"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionledger.sources import scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); the label is the smallest node.

    Each round gives a node the smallest label of its neighbours, passes it on to the
    node it pointed to, and jumps to the label's label; that halves chains, so rounds grow
    with the logarithm of the longest path. Every round is one written table: nothing is
    gathered, and a hub's edges are combined before they are shuffled.
    """
    e = scratch.materialise(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    )
    labels = scratch.materialise(e.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = (
            e.join(labels, e["b"] == labels["node"]).groupBy(F.col("a").alias("at")).agg(F.min("label").alias("least"))
        )
        seen = labels.join(near, labels["node"] == near["at"]).select("node", "label", "least")
        hooked = (
            seen.select("node", F.least("label", "least").alias("label"))
            .unionAll(seen.select(F.col("label").alias("node"), F.col("least").alias("label")))
            .groupBy("node").agg(F.min("label").alias("label"))
        )
        up = hooked.select(F.col("node").alias("n"), F.col("label").alias("l"))
        new = scratch.materialise(
            hooked.join(up, hooked["label"] == up["n"]).select("node", F.least("label", "l").alias("label"))
        )
        old = labels.select(F.col("node").alias("n"), F.col("label").alias("l"))
        moved = new.join(old, new["node"] == old["n"]).where("label != l").limit(1).count()
        labels = new
        if not moved:
            return labels
