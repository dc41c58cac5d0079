"""Connected components of a link table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and itself.

    ``edges`` has ``a > b``.  The large star moves the larger neighbours of a node, the
    small star its smaller ones and itself.  Both keep the components; minima are
    pre-aggregated, so a node with very many neighbours is one partial row per task.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(id, component): for each node with a link, the smallest node it reaches.

    Every round is written to the shared folder; rounds end when the links no longer
    change, after a number that grows with the logarithm of the nodes.
    """
    edges = saved(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                  .where("a <> b").distinct(), "links")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(edges)
    for _ in range(max_rounds):
        edges = saved(_star(saved(_star(edges, True), "links"), False), "links")
        now = mark(edges)
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
