"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import keep


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``links(a, b)``; ``comp`` is the
    smallest node of the component.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so paths shorten by powers of two. Rounds are written
    tables; only a count returns to the driver. Empty links give no rows.
    """
    ends = keep(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "ends")
    labels = keep(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                  .select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        near = (ends.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        lower = labels.join(near, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        moved = keep(lower.join(up, "comp").select("node", "old", F.least("comp", "top").alias("comp")), "labels")
        labels = moved.select("node", "comp")
        if moved.where("comp <> old").isEmpty():
            return labels


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(node, comp)`` after the new ``links(a, b)`` between nodes."""
    to = lambda end: labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
    between = (links.join(to("a"), "a").join(to("b"), "b")
               .select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).where("a <> b").distinct())
    merged = connected_components(between).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    return keep(labels.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), "labels")
