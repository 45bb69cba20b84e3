"""Triangles (tri, x1..z3) against points, planes and cells. Triangles are listed under the cells of their box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.spatial import cell


def boxed(df: DataFrame, x0: Column, x1: Column, y0: Column, y1: Column, size: float) -> DataFrame:
    """Each row once in each square cell that its box meets: adds gx and gy."""
    return df.withColumn("gx", F.explode(F.sequence(cell(x0, size), cell(x1, size)))).withColumn("gy", F.explode(F.sequence(cell(y0, size), cell(y1, size))))


def box(df: DataFrame, size: float) -> DataFrame:
    xs, ys = (["x1", "x2", "x3"], ["y1", "y2", "y3"])
    return boxed(df, F.least(*xs), F.greatest(*xs), F.least(*ys), F.greatest(*ys), size)


#: Barycentric weights of (x, y), as SQL.
DET = "((y2 - y3) * (x1 - x3) + (x3 - x2) * (y1 - y3))"
W1 = f"(((y2 - y3) * (x - x3) + (x3 - x2) * (y - y3)) / {DET})"
W2 = f"(((y3 - y1) * (x - x3) + (x1 - x3) * (y - y3)) / {DET})"


def points_in_triangles(points: DataFrame, tris: DataFrame, size: float = 20.0, slack: float = 1e-6) -> DataFrame:
    """(id, tri, z): of the triangles around a point the one it lies deepest in, the first at ties. Degenerate triangles hold nothing."""
    placed = points.select("id", "x", "y", cell(F.col("x"), size).alias("gx"), cell(F.col("y"), size).alias("gy"))
    met = placed.join(box(tris.where(f"{DET} <> 0"), size), ["gx", "gy"]).withColumns({"w1": F.expr(W1), "w2": F.expr(W2)})
    scored = met.withColumns({"score": F.expr("least(w1, w2, 1 - w1 - w2)"), "z": F.expr("w1 * z1 + w2 * z2 + (1 - w1 - w2) * z3")}).where(F.col("score") > -slack)
    best = scored.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("s"), "tri", "z")).alias("m"))
    return best.select("id", "m.tri", "m.z")


def burn(tris: DataFrame, size: float) -> DataFrame:
    """(r, c, top): the highest z over the centre of each cell that triangles cover."""
    spread = box(tris.where(f"{DET} <> 0"), size).withColumns({"x": (F.col("gx") + 0.5) * size, "y": (F.col("gy") + 0.5) * size}).withColumns({"w1": F.expr(W1), "w2": F.expr(W2)})
    inner = spread.where("least(w1, w2, 1 - w1 - w2) >= -1e-9")
    return inner.groupBy(F.col("gy").alias("r"), F.col("gx").alias("c")).agg(F.max(F.expr("w1 * z1 + w2 * z2 + (1 - w1 - w2) * z3")).alias("top"))


def corner(n: int) -> Column:
    return F.struct(F.col(f"z{n}").alias("z"), F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"))


def split(tris: DataFrame, level: float) -> DataFrame:
    """(tri, below, p, q, s): the one to three triangles that a horizontal plane cuts each triangle into.

    Corners are sorted by height, so windings are not kept. A corner at the level counts as above.
    """
    sorted_ = tris.select("tri", F.array_sort(F.array(corner(1), corner(2), corner(3))).alias("k")).select("tri", *[F.col("k")[n].alias(n_) for n, n_ in enumerate("abc")])
    under = sum((F.col(f"{k}.z") < level).cast("int") for k in "abc")

    def cut(p: str, q: str) -> Column:
        t = (F.lit(level) - F.col(f"{p}.z")) / (F.col(f"{q}.z") - F.col(f"{p}.z"))
        return F.struct(F.lit(level).alias("z"), *[(F.col(f"{p}.{v}") + t * (F.col(f"{q}.{v}") - F.col(f"{p}.{v}"))).alias(v) for v in "xy"])

    def piece(below: bool, *corners: Column | str) -> Column:
        return F.struct(F.lit(below).alias("below"), *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(corners, "pqs")])

    ab, ac, bc = cut("a", "b"), cut("a", "c"), cut("b", "c")
    pieces = (
        F.when(under == 0, F.array(piece(False, "a", "b", "c")))
        .when(under == 3, F.array(piece(True, "a", "b", "c")))
        .when(under == 1, F.array(piece(True, "a", ab, ac), piece(False, ab, "b", "c"), piece(False, ab, "c", ac)))
        .otherwise(F.array(piece(False, "c", ac, bc), piece(True, "a", "b", bc), piece(True, "a", bc, ac)))
    )
    return sorted_.select("tri", F.inline(pieces))


def half_edges(tris: DataFrame) -> DataFrame:
    """(tri, v1, v2) of each triangle's three edges, the smaller vertex first."""
    ends = [("v1", "v2"), ("v2", "v3"), ("v3", "v1")]
    return tris.select("tri", F.inline(F.array(*[F.struct(F.least(a, b).alias("v1"), F.greatest(a, b).alias("v2")) for a, b in ends])))


def neighbours(tris: DataFrame) -> DataFrame:
    """(v1, v2, users, a, b): how many triangles use each edge, and the least and the largest of them; no self-join."""
    return half_edges(tris).groupBy("v1", "v2").agg(F.count(F.lit(1)).alias("users"), F.min("tri").alias("a"), F.max("tri").alias("b"))
