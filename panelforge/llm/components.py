"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.tables import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``(a, b) -> (id, component): the smallest id reachable, for every id in an edge.

    Every round gives each node the smallest label among itself and its neighbours, then that
    label's own label if it is smaller; the round's table is staged, so lineage stays short
    and lost executors cost one round at most. It ends when no edge joins two labels. All steps
    are joins and map-side combined aggregates; a node with very many edges is split by AQE's
    skew join. No edges: an empty result. Self-loops are kept as single nodes; repeated edges and
    nulls (dropped) do no harm.
    """
    both = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna()
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.distinct(), "cc-edges")
    labels = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")), "cc-labels")
    while True:
        other = labels.select(F.col("a").alias("b"), F.col("component").alias("other"))
        best = both.join(other, "b").groupBy("a").agg(F.min("other").alias("other"))
        moved = labels.join(best, "a").select("a", F.least("component", "other").alias("near"), F.col("component").alias("was"))
        far = labels.select(F.col("a").alias("near"), F.col("component").alias("far"))
        moved = moved.join(far, "near").select("a", F.least("near", "far").alias("component"), "was")
        labels = staged(moved, "cc-labels")
        if labels.where("component <> was").isEmpty():
            return labels.select(F.col("a").alias("id"), "component")
        labels = labels.drop("was")
