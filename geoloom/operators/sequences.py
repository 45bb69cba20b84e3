"""Sums and numbers along an order of all rows, without all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets in a group.
WIDE = 4096


def prefix_sums(df: DataFrame, bucket: Column, order: list[Column], value: str, out: str) -> DataFrame:
    """Adds the sum of value over the rows before each, by bucket, then order.

    bucket is a whole number that rises with the order. Its totals are summed in two
    levels, within the groups of WIDE buckets and over the groups, and rows within
    their bucket; so a task holds a bucket, WIDE totals, or a total for every WIDE
    buckets. The order has no ties.
    """
    rows = df.withColumn("_bucket", bucket.cast("long"))
    totals = rows.groupBy("_bucket").agg(F.sum(value).alias("_total")).withColumn("_group", F.floor(F.col("_bucket") / WIDE))
    groups = totals.groupBy("_group").agg(F.sum("_total").alias("_all"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.select("_group", (F.sum("_all").over(upto(Window.orderBy("_group"))) - F.col("_all")).alias("_start"))
    own = F.sum("_total").over(upto(Window.partitionBy("_group").orderBy("_bucket"))) - F.col("_total")
    before = totals.withColumn("_own", own).join(groups, "_group").select("_bucket", (F.col("_own") + F.col("_start")).alias("_before"))
    summed = rows.withColumn("_inside", F.sum(value).over(upto(Window.partitionBy("_bucket").orderBy(*order))) - F.col(value))
    return summed.join(before, "_bucket").withColumn(out, (F.col("_before") + F.col("_inside")).cast("long")).drop("_bucket", "_before", "_inside")
