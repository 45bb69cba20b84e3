"""Registers as streams: an extension, with the state bounded by watermarks.

The same plans run over a table at once or over files as they come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def follow(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    """Rows of Parquet files as they come into a folder, at most `files` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def current(rows: DataFrame, id: str, ended: str, at: str, late: str = "1 day") -> DataFrame:
    """Rows not ended, the first to arrive of each id; an id is forgotten `late` after its time. Rows without an id all stay."""
    now = rows.where(F.coalesce(F.col(ended), F.lit("")) == "")
    named = F.coalesce(F.col(id), F.lit("")) != ""
    first = now.where(named).withWatermark(at, late).dropDuplicatesWithinWatermark([id]) if rows.isStreaming else now.where(named).dropDuplicates([id])
    return first.unionByName(now.where(~named))


def counts_by_window(rows: DataFrame, at: str, kind: str, size: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """(start, kind, n) of tumbling windows, or sliding ones with slide."""
    marked = rows.withWatermark(at, late) if rows.isStreaming else rows
    window = F.window(at, size, slide) if slide else F.window(at, size)
    return marked.groupBy(window.alias("w"), F.col(kind)).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
