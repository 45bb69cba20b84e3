"""Refining triangles until they fit points, in rounds over all triangles at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.operators.graph import written
from geoloom.operators.mesh import W1, W2, boxed, box

CORNERS = [f"{a}{k}" for k in (1, 2, 3) for a in "xyz"]
#: How far outside a triangle, in barycentric weight, a point still counts as in it.
SLACK = 1e-9


def weighed(met: DataFrame) -> DataFrame:
    """Adds least, the least barycentric weight of a point in a triangle, and off, its height over it."""
    at = met.select("*", F.inline(F.array(F.struct(F.expr(W1).alias("w1"), F.expr(W2).alias("w2")))))  # worked out once, not in each use
    return at.select("*", F.least("w1", "w2", 1 - F.col("w1") - F.col("w2")).alias("least"), F.abs(F.col("z") - F.expr("w1 * z1 + w2 * z2 + (1 - w1 - w2) * z3")).alias("off"))


def until_fit(triangles: DataFrame, points: DataFrame, tolerance: float, rounds: int = 60, size: float = 250.0) -> DataFrame:
    """Triangles (tri string, x1..z3) split at their worst point (id, x, y, z) while it is further off than the tolerance.

    The three parts of a triangle are named by its name and 1 to 3; parts without
    area are left out. Points outside all triangles, or with a null, count for
    nothing; of points equally far off the least id is taken. A point belongs to
    the triangle it is deepest in, so a round joins points and triangles on the
    name alone; rounds are written to the shared folder. Points at one place must have one height.
    If `rounds` rounds don't do, RuntimeError: nothing half done is returned.
    """
    done = triangles.select("tri", *CORNERS)
    placed = points.where("x is not null and y is not null and z is not null").select("id", "x", "y", "z")
    listed = boxed(placed, F.col("x"), F.col("x"), F.col("y"), F.col("y"), size)
    met = weighed(listed.join(box(done, size), ["gx", "gy"])).where(F.col("least") >= -SLACK)
    owned = written(met.groupBy("id", "x", "y", "z").agg(F.max(F.struct("least", "tri")).alias("m")).select("id", "x", "y", "z", "m.tri"))
    now, kept = written(done), []
    for _ in range(rounds):
        worst = weighed(owned.join(now, "tri")).where(F.col("off") > tolerance).groupBy("tri").agg(F.min(F.struct((-F.col("off")).alias("o"), "id", "x", "y", "z")).alias("p"))
        worst = written(worst.select("tri", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.z").alias("z")))
        if worst.isEmpty():
            break
        kept.append(written(now.join(worst, "tri", "left_anti")))
        part = lambda k: F.struct(F.concat("tri", F.lit(str(k))).alias("tri"), *[(F.col(c[0]) if c[1] == str(k) else F.col(c)).alias(c) for c in CORNERS])
        split = now.join(worst, "tri")
        now = split.select(F.col("tri").alias("parent"), F.inline(F.array(*map(part, (1, 2, 3)))))
        now = written(now.where("abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) > 1e-9"))
        inside = weighed(owned.withColumnRenamed("tri", "parent").join(now, "parent"))
        owned = written(inside.groupBy("id", "x", "y", "z").agg(F.max(F.struct("least", "tri")).alias("m")).select("id", "x", "y", "z", "m.tri"))
        now = now.drop("parent")
    else:
        raise RuntimeError(f"triangles don't fit after {rounds} rounds")
    for part in kept:
        now = now.unionByName(part)
    return now
