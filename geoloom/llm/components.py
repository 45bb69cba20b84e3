"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import cut, met


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Edges (u, v) with u > v. Large: each node's larger neighbours move to its least neighbour. Small: its smaller ones do.

    The least neighbour is a grouped minimum joined back, hot nodes over several tasks, so that no task holds a node's neighbours.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("size")).select("u", F.least("u", "m").alias("m"), "size")
    joined = met(both, least, "u", total, "v")
    moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    )
    return moved.where("u > v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each larger end has one edge and is no smaller end: then the smaller ends are the labels."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("top")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("top")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("top").alias("top")).where("up > 1 or up = 1 and top = 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, label) of every node that has an edge to another; label is the least node of its component.

    Edges count both ways; loops, repeats and nulls are ignored; no edges give no
    rows. Each round's edges go to the shared checkpoint folder. rows: how many edges there are, about or at most, if known.
    """
    now = cut(edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), rows)

    while not _settled(now):
        edges = now.count()
        now = cut(_star(_star(now, True, 2 * edges), False, 2 * edges), 2 * edges)  # a star has no more edges than twice those before
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
