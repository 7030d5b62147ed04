"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.llm.common import Workspace


def connected(links: DataFrame, work: Workspace) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id reachable.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so long chains halve. Rounds are written to the shared folder; only a count of
    changed labels reaches the driver. Links with a null end are ignored.
    """
    pairs = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = work.staged(pairs.unionAll(turned).distinct())
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
    labels = work.staged(labels.select("id", F.least("id", "near").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id"))
        moved = labels.join(near.agg(F.min("component").alias("near")), "id").select(
            "id", F.least("component", "near").alias("component"), F.col("component").alias("before")
        )
        moved = work.staged(moved)
        target = moved.select(F.col("id").alias("component"), F.col("component").alias("further"))
        jumped = moved.join(target, "component").select("id", F.col("further").alias("component"), "before")
        jumped = work.staged(jumped)
        labels = jumped.select("id", "component")
        if jumped.where("component != before").isEmpty():
            return labels
