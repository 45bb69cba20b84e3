"""Connected components by stars, and what iterations leave behind."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """The folder for checkpoints, that of spark.checkpoint.dir; where that is unset, a temporary one for a local master, as in tests, and an error on a cluster."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared_by_all = spark.conf.get("spark.checkpoint.dir", None)
        if not shared_by_all and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(shared_by_all or tempfile.mkdtemp())
    return context._jsc.sc().getCheckpointDir().get()


def shared(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like shared, by a table. Estimates of its size start anew there, whereas a checkpoint keeps them, and joins in many rounds multiply them without end."""
    path = f"{folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node that each node reaches, of every node that has an edge.

    By stars, in rounds that double what a node knows: each node's larger neighbours
    are tied to the least one around it, then its smaller ones are, until every node is tied to its label alone.
    Minima are grouped and joined back, and each round is written.
    """
    nodes = written(edges.select(F.explode(F.array(a, b)).alias("node")).distinct())
    now = written(edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(both.where("v > u").join(around, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(least.select("u", F.col("m").alias("v")))
        new = written(small.distinct())
        if new.count() == now.count() and new.join(now, ["u", "v"], "left_anti").isEmpty():
            return nodes.join(new.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left").select("node", F.coalesce("label", "node").alias("label"))
        now = new
