"""Connected components by alternating large-star and small-star rounds.

Edges never leave Spark: each round is a minimum per node (pre-aggregated) and
a join back, so a node with very many neighbours costs one row per map task and
a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    own = both if large else both.where("v < u")
    low = own.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    far = own.where("v > u") if large else own
    moved = far.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(low.select("u", F.col("m").alias("v")))
    return moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(node, root)`` with root = smallest node
    reachable.  Only nodes that have an edge to another node appear (the root
    itself does not need to); self loops are ignored."""
    e = cut(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    mark = _mark(e)
    while mark[0]:
        nxt = cut(_star(_star(e, True), False))
        new = _mark(nxt)
        if new == mark:
            break
        e, mark = nxt, new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
