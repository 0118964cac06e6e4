"""Connected components of a link table, by smallest-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.session import cut_lineage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; a component is named by its smallest node.

    Each round every node takes the smallest label around it and then the label of that label, so long
    chains halve. Rounds write their labels to the shared folder; only a count of changes reaches the driver.
    A hub with many links is aggregated per task before its shuffle.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b")))
    # every link both ways, and every node beside itself
    both = cut_lineage(pairs.select(ends.alias("e")).select("e.a", "e.b").distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")))
    total = None
    while True:
        # labels only fall, so an equal sum means that none has changed
        before, total = total, labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            return labels
        heard = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        far = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        labels = cut_lineage(heard.join(far, "near").select("node", F.least("near", "far").alias("component")))
