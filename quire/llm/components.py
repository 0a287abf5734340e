"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored


EDGES = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges``: the smallest node id of its component.

    Each round takes the smallest label among the neighbours and then the label's own label; every round is
    written to the shared folder, so the plan stays short and a lost executor costs one round at most.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    both = stored(both.union(both.select("other", "node")).distinct(), "edges")
    # Few edges need few tasks; every task gets EDGES of them at most.
    tasks = both.count() // EDGES + 1
    labels = stored(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")).coalesce(tasks), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "seen").alias("next"))
        lower = stored(lower.coalesce(tasks), "lower")
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("far"))
        after = stored(lower.join(jump, "next").select("node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved")).coalesce(tasks), "labels")
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels
