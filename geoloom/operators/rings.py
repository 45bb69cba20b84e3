"""Faces that share their corners, as rows (face, seq, x, y): corners leave all the faces that have them, so no gap opens.

Corners are the same if they agree to a millimetre.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.operators.graph import shared
from geoloom.operators.lines import keep_mask

KEY = ["kx", "ky"]


def keyed(faces: DataFrame) -> DataFrame:
    return faces.withColumns({k: F.rint(F.col(c) * 1000).cast("long") for k, c in zip(KEY, "xy")})


def around(column: str, step: int) -> Column:
    """The value at the next (1) or previous (-1) corner of the ring."""
    w = Window.partitionBy("face").orderBy("seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.lead(column).over(w), F.first(column).over(whole)) if step > 0 else F.coalesce(F.lag(column).over(w), F.last(column).over(whole))


def meeting_places(corners: DataFrame) -> DataFrame:
    """(kx, ky) of the corners that do not have just two neighbours."""
    sides = corners.select(*KEY, around("kx", 1).alias("nx"), around("ky", 1).alias("ny"))
    both = sides.unionByName(sides.select(F.col("nx").alias("kx"), F.col("ny").alias("ky"), F.col("kx").alias("nx"), F.col("ky").alias("ny"))).distinct()
    return both.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n <> 2").select(*KEY)


def runs(ring: list[tuple[int, int]], fixed: list[bool]) -> Iterator[list[tuple[int, int]]]:
    """The stretches between fixed corners, each from its lesser end, so that both faces beside it see the same."""
    at = [i for i, f in enumerate(fixed) if f]
    if len(at) >= 2:
        for a, b in zip(at, at[1:] + [at[0] + len(ring)]):
            run = [ring[i % len(ring)] for i in range(a, b + 1)]
            yield run if run[0] <= run[-1] else run[::-1]


def straighten(faces: DataFrame, tolerance: float) -> DataFrame:
    """Faces less the corners that a line between two meeting places does without, to the tolerance.

    A face keeps three corners at least: all of its corners come back, for its
    neighbours too. Each face goes to one task, no group of faces does. Rounds of
    putting back are checkpointed.
    """
    corners = shared(keyed(faces))
    fixed = meeting_places(corners).withColumn("fixed", F.lit(True))
    rings = corners.join(fixed, KEY, "left").groupBy("face").agg(F.sort_array(F.collect_list(F.struct("seq", *KEY, F.coalesce("fixed", F.lit(False)).alias("fixed")))).alias("ring"))

    def dropped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for ring in b["ring"]:
                for run in runs([(p["kx"], p["ky"]) for p in ring], [p["fixed"] for p in ring]):
                    out += [p for p, k in zip(run, keep_mask(np.array(run, float) / 1000, tolerance)) if not k]
            yield pd.DataFrame(out, columns=KEY).astype("int64")

    gone = shared(rings.select("ring").mapInPandas(dropped, "kx long, ky long").distinct())
    while True:
        marked = corners.join(gone.withColumn("gone", F.lit(True)), KEY, "left")
        short = marked.groupBy("face").agg(F.count_if(F.col("gone").isNull()).alias("left")).where("left < 3").select("face")
        back = shared(marked.where("gone").join(short, "face", "left_semi").select(*KEY).distinct())
        if back.isEmpty():
            return marked.where("gone is null").select(*faces.columns)
        gone = shared(gone.join(back, KEY, "left_anti"))


def hairpins(corners: DataFrame, limit: float, most: float, always: float) -> DataFrame:
    """Corners sharper than the limit in degrees that cut off at most `most` of area, or are sharper than `always`."""
    at = corners.withColumns({"bx": around("x", -1) - F.col("x"), "by": around("y", -1) - F.col("y"), "ax": around("x", 1) - F.col("x"), "ay": around("y", 1) - F.col("y")})
    lengths = F.sqrt(F.expr("bx * bx + by * by")) * F.sqrt(F.expr("ax * ax + ay * ay"))
    at = at.withColumns({"cosine": F.when(lengths > 0, F.expr("bx * ax + by * ay") / lengths).otherwise(-1.0), "area": F.abs(F.expr("bx * ay - by * ax")) / 2})
    return at.where((F.col("cosine") > math.cos(math.radians(limit))) & ((F.col("area") <= most) | (F.col("cosine") > math.cos(math.radians(always)))))


def is_ring(xy: np.ndarray) -> bool:
    """At least three corners, some area, and no two sides that cross."""
    if len(xy) < 3:
        return False
    nxt = np.roll(xy, -1, axis=0)
    if abs((xy[:, 0] * nxt[:, 1] - nxt[:, 0] * xy[:, 1]).sum()) <= 0:
        return False
    side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    for a, b in zip(xy, nxt):
        if np.any((side(a, b, xy) * side(a, b, nxt) < 0) & (side(xy, nxt, a[None]) * side(xy, nxt, b[None]) < 0)):
            return False
    return True


def broken(corners: DataFrame) -> DataFrame:
    """(face) of the rings that is_ring refuses."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.loc[[not is_ring(np.array([[p["x"], p["y"]] for p in ring], float).reshape(-1, 2)) for ring in b["ring"]], ["face"]]

    rings = corners.groupBy("face").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("ring"))
    return rings.mapInPandas(run, f"face {dict(corners.dtypes)['face']}")


def without_hairpins(faces: DataFrame, sharp_in: Column, limit: float, most: float, always: float) -> DataFrame:
    """Faces less the hairpins of those that sharp_in chooses.

    Taking a tip may leave the corner behind it as the new tip, so this goes in
    rounds. A corner stays if a face would break without the corners of its round;
    a round that spares all its corners is the last, and every other takes a corner. Only the faces with a corner
    that goes are looked at, and each round is checkpointed.
    """
    now = shared(keyed(faces))
    while True:
        drop = shared(hairpins(now.where(sharp_in), limit, most, always).select(*KEY).distinct())
        while not drop.isEmpty():
            touched = now.join(now.join(drop, KEY, "left_semi").select("face").distinct(), "face", "left_semi")
            rest = touched.join(drop, KEY, "left_anti")
            emptied = touched.select("face").distinct().join(rest.select("face").distinct(), "face", "left_anti")
            bad = broken(rest).unionByName(emptied)
            spared = shared(touched.join(bad, "face", "left_semi").select(*KEY).distinct().join(drop, KEY, "left_semi"))
            if spared.isEmpty():
                break
            drop = shared(drop.join(spared, KEY, "left_anti"))
        if drop.isEmpty():
            break
        now = shared(now.join(drop, KEY, "left_anti"))
    return now.select(*faces.columns)
