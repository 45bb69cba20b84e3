"""Operators on rasters in long form: row r, column c and a whole number zc of hundredths. Missing cells are holes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.graph import shared


def offsets(radius: int, keep=lambda dr, dc: True) -> Column:
    return F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in range(-radius, radius + 1) for dc in range(-radius, radius + 1) if keep(dr, dc)])


def spread(cells: DataFrame, around: Column) -> DataFrame:
    """Each cell's value at the places that see it: (r, c, zc, dr, dc)."""
    moved = cells.select("r", "c", "zc", F.explode(around).alias("o"))
    return moved.select((F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"), "zc", "o.dr", "o.dc")


def focal(cells: DataFrame, radius: int, aggregates: list[Column], keep=lambda dr, dc: True) -> DataFrame:
    """Aggregates of zc over the window around each present cell. Sums of what each cell sends combine before the shuffle."""
    return spread(cells, offsets(radius, keep)).groupBy("r", "c").agg(*aggregates).join(cells, ["r", "c"])


def fill_holes(cells: DataFrame, rows: int, columns: int) -> DataFrame:
    """Fills holes from their eight neighbours, all at once in each round, by the mean floored to a hundredth.

    Goes on until nothing is missing; each round fills what touches a cell that is there. Raises
    ValueError if nothing is present in the raster. Each round's cells are checkpointed.
    """
    now = cells.select("r", "c", "zc").where(f"zc is not null and r between 0 and {rows - 1} and c between 0 and {columns - 1}")
    have, want = now.count(), rows * columns
    if not have:
        raise ValueError("no cell has a value")
    while have < want:
        seen = spread(now, offsets(1)).where(f"r between 0 and {rows - 1} and c between 0 and {columns - 1}").groupBy("r", "c")
        means = seen.agg(F.max(F.when((F.col("dr") == 0) & (F.col("dc") == 0), F.col("zc"))).alias("own"), F.floor(F.sum("zc") / F.count("zc")).alias("mean"))
        now = means.select("r", "c", F.coalesce("own", "mean").cast("long").alias("zc"))
        now = shared(now)
        have = now.count()
    return now


def local_peaks(cells: DataFrame, radius: int) -> DataFrame:
    """Cells that no cell of their window exceeds; ties all stay."""
    return focal(cells, radius, [F.max("zc").alias("top")]).where("zc >= top").select("r", "c", "zc")


def smoothed(full: DataFrame, rows: int, columns: int, passes: int = 1) -> DataFrame:
    """(r, c, z): the mean of the 3 x 3 window of a raster (r, c, z) without holes, the edge cells repeated outwards; so often over.

    Each cell sends its value to the windows it is in, once for each of their nine places it stands at.
    """
    heard = lambda at, last: F.filter(F.array(at - 1, at, at + 1, F.when(at == 0, at), F.when(at == last, at)), lambda x: (x >= 0) & (x <= last))
    for _ in range(passes):
        sent = full.select(F.explode(heard(F.col("r"), F.lit(rows - 1))).alias("r"), "c", "z").select("r", F.explode(heard(F.col("c"), F.lit(columns - 1))).alias("c"), "z")
        full = sent.groupBy("r", "c").agg((F.sum("z") / 9).alias("z"))
    return full
