"""Graph operators over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge.

    Each round every node takes the smallest root among its neighbours' and then its root's
    root, so that long chains shrink by pointer jumping. Every round is a partially combined
    aggregate and two equi-joins on nodes, kept in the checkpoint folder. Null ends are ignored,
    self-loops keep their node. An empty edge table gives an empty result.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna()
    both = durable(pairs.unionAll(pairs.select("b", "a")).distinct())
    size = both.count()
    roots = durable(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), size)
    if not size:
        return roots
    for _ in range(max_rounds):
        offered = both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("offer"))
        lower = roots.join(offered, roots.node == offered.a).select("node", F.col("root").alias("was"), F.least("root", "offer").alias("root"))
        above = roots.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        jumped = durable(lower.join(above, lower.root == above.n2).select("node", F.least("root", "r2").alias("root"), (F.least("root", "r2") < F.col("was")).alias("moved")), size)
        roots = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return roots
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
