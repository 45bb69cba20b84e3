"""Refined triangles and cuts of roads, by what must hold for them."""

import numpy as np
import pytest
from geoloom.operators import lines, refine
from geoloom.plans import catalog

SF = "/root/testdata/sf0.001"
TWO = [("0", 0.0, 0.0, 0.0, 10.0, 0.0, 0.0, 10.0, 10.0, 0.0), ("1", 0.0, 0.0, 0.0, 10.0, 10.0, 0.0, 0.0, 10.0, 0.0)]
KIND = "tri string, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double, x3 double, y3 double, z3 double"


def heights(t, x, y):
    """The height of each triangle of t at (x, y), and the point's least weight in it."""
    det = (t.y2 - t.y3) * (t.x1 - t.x3) + (t.x3 - t.x2) * (t.y1 - t.y3)
    a = ((t.y2 - t.y3) * (x - t.x3) + (t.x3 - t.x2) * (y - t.y3)) / det
    b = ((t.y3 - t.y1) * (x - t.x3) + (t.x1 - t.x3) * (y - t.y3)) / det
    return a * t.z1 + b * t.z2 + (1 - a - b) * t.z3, np.minimum(np.minimum(a, b), 1 - a - b)


def test_every_point_fits_and_the_area_stays(spark):
    rng = np.random.default_rng(3)
    points = [(k, *map(float, np.round(rng.random(2) * 10, 2)), float(np.round(rng.random() * 5, 2))) for k in range(80)]
    t = refine.until_fit(spark.createDataFrame(TWO, KIND), spark.createDataFrame(points, "id long, x double, y double, z double"), 0.5, size=4.0).toPandas()
    area = ((t.x2 - t.x1) * (t.y3 - t.y1) - (t.x3 - t.x1) * (t.y2 - t.y1)) / 2
    assert area.sum() == pytest.approx(100) and (area > 0).all() and t.tri.is_unique and len(t) > 20
    for _, x, y, z in points:
        height, least = heights(t, x, y)
        assert abs(height[least.idxmax()] - z) <= 0.5 + 1e-6


def test_nothing_to_refine(spark):
    two = spark.createDataFrame(TWO, KIND)
    points = spark.createDataFrame([(1, 5.0, 2.0, 0.2), (2, 50.0, 50.0, 9.0), (3, None, 1.0, 9.0)], "id long, x double, y double, z double")
    assert sorted(refine.until_fit(two, points, 0.5).collect()) == sorted(two.collect())
    assert refine.until_fit(two, points.where("false"), 0.5).count() == 2


def test_cuts_that_stay_do_not_cross(spark):
    kept = catalog.QUERIES["x11_road_cuts"](spark, SF).cache()
    assert kept.count() > 100
    assert lines.crossings(kept.withColumnRenamed("id", "seg").select("seg", "px", "py", "qx", "qy"), 24.0).isEmpty()
