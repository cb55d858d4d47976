"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.session import discard, materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges(a, b)``.

    Each round takes the least label among a node and its neighbours, then the label of that
    label; labels are written to the shared folder and compared by one aggregate.
    """
    both = edges.where("a is not null and b is not null and a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    links = materialize(both.select(F.col("e.a").alias("node"), F.col("e.b").alias("other")).distinct(), "links")
    labels = materialize(links.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "labels")
    for _ in range(max_rounds):
        near = links.join(labels.withColumnRenamed("node", "other"), "other").select("node", "root")
        least = labels.unionByName(near).groupBy("node").agg(F.min("root").alias("root"))
        jumped = least.join(labels.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left").select("node", F.least("root", "up").alias("root"))
        after = materialize(jumped, "labels")
        changed = after.join(labels.withColumnRenamed("root", "before"), "node").where("root <> before").limit(1).count()
        discard(labels)
        labels = after
        if not changed:
            return labels
    raise RuntimeError(f"not stable after {max_rounds} rounds")
