"""Connected components of links by rounds of large-star and small-star, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.tables import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One round over links (u, v) with u > v.  Large: neighbours above a node get its smallest
    neighbour.  Small: a node and its neighbours below get the smallest of them."""
    if small:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    else:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (u, v); nodes without links are absent.

    Every round is written below spark.checkpoint.dir, so the plan stays short and
    a lost executor costs one round at most.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = written(_star(_star(edges, small=False), small=True))
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
