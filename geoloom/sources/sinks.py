"""Writing what stages hand on: partitioned tables, JSON lists, world files, land cover with its legend, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_raster(cells: DataFrame, path: str, tile: int = 256) -> None:
    """Cells as a table partitioned by tile; a tile's rows come from one task, so that it is one file unless it is large."""
    tiled = cells.withColumns({"tile_r": F.floor(F.col("r") / tile), "tile_c": F.floor(F.col("c") / tile)})
    tiled.repartition("tile_r", "tile_c").sortWithinPartitions("tile_r", "tile_c", "r", "c").write.mode("overwrite").partitionBy("tile_r", "tile_c").parquet(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """A folder of tables, such as the triangles, owners and attributes of buildings."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_land_cover(cells: DataFrame, legend: list[tuple[int, str]], rows: int, path: str) -> None:
    """Classes by cell with north up, and their names."""
    spark = cells.sparkSession
    write_tables({"cells": cells.withColumn("r", F.lit(rows - 1) - F.col("r")), "legend": spark.createDataFrame(legend, "class int, name string")}, path)


def tree_list(trees: DataFrame, x0: float, y0: float) -> DataFrame:
    """Trees (x, y, height_m, crown_radius_m, trunk_height_m, ...) in local coordinates, z to the south."""
    return trees.select(
        *[c for c in trees.columns if c not in ("height_m", "crown_radius_m", "trunk_height_m")],
        *[F.round(c, 2).alias(c) for c in ("height_m", "crown_radius_m", "trunk_height_m")],
        F.struct(F.round(F.col("x") - x0, 3).alias("x"), F.round(F.lit(y0) - F.col("y"), 3).alias("z")).alias("local"),
    )


def vehicle_list(vehicles: DataFrame, x0: float, y0: float) -> DataFrame:
    """Vehicles (x, y, heading in radians against the clock from east, ...) with the compass heading in degrees."""
    compass = F.lit(90.0) - F.degrees("heading")
    return vehicles.select(
        *[c for c in vehicles.columns if c != "heading"],
        F.round(compass - 360 * F.floor(compass / 360), 1).alias("heading_deg"),
        F.struct(F.round(F.col("x") - x0, 3).alias("x"), F.round(F.lit(y0) - F.col("y"), 3).alias("z")).alias("local"),
    )


def world_file(xmin: float, ymax: float, width_m: float, height_m: float, columns: int, rows: int) -> str:
    """Six lines that place an image: its pixel size, and the centre of the pixel in its north-west corner."""
    px, py = width_m / columns, height_m / rows
    return "".join(f"{v:.10f}\n" for v in (px, 0.0, 0.0, -py, xmin + px / 2, ymax - py / 2))


def report(spark: SparkSession, checks: list[tuple[str, bool, str, str]]) -> DataFrame:
    """Checks (name, passed, severity, detail) as rows."""
    return spark.createDataFrame(checks, "name string, passed boolean, severity string, detail string")


def report_ok(checks: DataFrame) -> bool:
    """Whether no check of severity error failed; a check without a verdict has failed."""
    return checks.where((F.col("severity") == "error") & ~F.coalesce("passed", F.lit(False))).isEmpty()


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
