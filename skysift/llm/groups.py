"""Problem 7: one identifier for everything linked by pairwise matches (hash-to-min)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.session import discard, materialize

#: A vertex whose cluster holds more than this share of all rows is hot: at most 1/share are.
HOT_SHARE = 0.001
LEAST_HOT = 10_000


def _next(clusters: DataFrame, rows: int) -> DataFrame:
    """One round: each vertex sends its cluster to its minimum, and the minimum to its cluster."""
    least = clusters.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
    if rows > LEAST_HOT:
        # fewer than 1 / HOT_SHARE vertices can be hot, whatever the input: safe to broadcast
        hot = F.broadcast(least.where(F.col("n") > max(LEAST_HOT, int(rows * HOT_SHARE))).select("v", "m"))
        cold = clusters.join(hot.select("v"), "v", "left_anti").join(least.select("v", "m"), "v")
        with_least = clusters.join(hot, "v").unionByName(cold)
    else:
        with_least = clusters.join(least.select("v", "m"), "v")
    to = F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))
    return with_least.select(to.alias("x")).select("x.v", "x.u").distinct()


def connected_groups(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest member of the group of each vertex of ``pairs(a, b)``: columns v, group.

    Hash-to-min: a vertex starts with itself and its neighbours; in each round it sends its
    cluster to the cluster's minimum and that minimum to all others, until nothing changes.
    Clusters are rows (vertex, member), never arrays, so that no task holds a large one, and
    vertices with very many members get their minimum by a broadcast of bounded size instead
    of by shuffling all their rows to one task. Every round is written to the shared folder.

    Null sides and pairs of equal sides link nothing and give no vertex. Repeated or reversed
    pairs count once. Empty input gives no rows.
    """
    edges = pairs.select("a", "b").where("a is not null and b is not null and a <> b")
    both = F.explode(F.array(*(F.struct(F.col(x).alias("v"), F.col(y).alias("u")) for x, y in ("ab", "ba", "aa", "bb"))))
    clusters = materialize(edges.select(both.alias("x")).select("x.v", "x.u").distinct(), "groups")
    mark = clusters.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first()
    for _ in range(max_rounds):
        after = materialize(_next(clusters, mark[0]), "groups")
        now = after.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first()
        discard(clusters)
        clusters, same, mark = after, now == mark, now
        if same:
            return clusters.groupBy("v").agg(F.min("u").alias("group"))
    raise RuntimeError(f"not stable after {max_rounds} rounds")
