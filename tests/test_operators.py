"""Small cases of the operators by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.operators import graph, raster, refine, registers, sequences, spatial
from geoloom.plans import shapes
from geoloom.sources.views import read, view


def test_current_versions_keep_rows_without_an_id(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, "a", None), (3, None, ""), (4, None, ""), (5, "", ""), (6, "b", "2020")], "seq long, id string, ended string")
    assert sorted(r.seq for r in registers.current_versions(df, "id", "ended", "seq").collect()) == [1, 3, 4, 5]


def test_point_in_polygon_leaves_out_the_hole(spark):
    poly = spark.createDataFrame([(1, 50.0, 50.0, 10.0, 5.0, 1.0, 1)], "id long, cx double, cy double, rad double, hole double, lev double, cls int")
    points = spark.createDataFrame([(1, 50.0, 50.1), (2, 57.0, 50.1), (3, 61.0, 50.1)], "id long, x double, y double")
    assert [r.point for r in spatial.points_in_polygons(points, poly).collect()] == [2]


def test_nearest_breaks_ties_by_id(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, -1.0, 0.0)], "id long, x double, y double")
    assert {r.id_a: r.id_b for r in spatial.nearest(points, points, 5.0).collect()} == {1: 2, 2: 1, 3: 1}


def test_fill_holes(spark):
    one = spark.createDataFrame([(0, 0, 7)], "r long, c long, zc long")
    full = raster.fill_holes(one, 5, 5)
    assert full.count() == 25 and {r.zc for r in full.collect()} == {7}
    with pytest.raises(ValueError):
        raster.fill_holes(one.where("false"), 5, 5)


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = graph.connected_components(edges).collect()
    assert len(found) == 60 and {r.label for r in found} == {1}


def test_smoothed_repeats_the_edges(spark):
    grid = np.random.default_rng(1).integers(0, 100, (5, 4)).astype(float)
    df = spark.createDataFrame([(r, c, float(grid[r, c])) for r in range(5) for c in range(4)], "r long, c long, z double")
    want = grid
    for _ in range(2):
        padded = np.pad(want, 1, mode="edge")
        want = sum(padded[a : a + 5, b : b + 4] for a in range(3) for b in range(3)) / 9
    got = raster.smoothed(df, 5, 4, passes=2).collect()
    assert len(got) == 20 and all(r.z == pytest.approx(want[r.r, r.c]) for r in got)


def test_fill_holes_by_hand(spark):
    rng = np.random.default_rng(2)
    cells = {(r, c): int(rng.integers(0, 1000)) for r in range(8) for c in range(8) if rng.random() < 0.15}
    full = raster.fill_holes(spark.createDataFrame([(r, c, z) for (r, c), z in cells.items()] + [(9, 9, 5), (0, 0, None)], "r long, c long, zc long"), 8, 8)
    now = dict(cells)
    while len(now) < 64:
        near = {(r, c): [now[a, b] for a in range(r - 1, r + 2) for b in range(c - 1, c + 2) if (a, b) in now] for r in range(8) for c in range(8) if (r, c) not in now}
        now |= {k: int(np.floor(sum(v) / len(v))) for k, v in near.items() if v}
    assert {(r.r, r.c): r.zc for r in full.collect()} == now


def test_refinement_is_never_half_done(spark):
    triangle = spark.createDataFrame([("0", 0.0, 0.0, 0.0, 10.0, 0.0, 0.0, 10.0, 10.0, 0.0)], "tri string, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double, x3 double, y3 double, z3 double")
    points = spark.createDataFrame([(k, 5.0 + k / 3, 1.0 + k / 5, float(k)) for k in range(6)], "id long, x double, y double, z double")
    with pytest.raises(RuntimeError):
        refine.until_fit(triangle, points, 0.01, rounds=1)


def test_prefix_sums_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(sequences, "WIDE", 3)
    rows = [(k, (k * 7) % 11) for k in range(200) if k % 5]
    got = sequences.prefix_sums(spark.createDataFrame(rows, "k long, n long"), F.floor(F.col("k") / 4), [F.col("k")], "n", "before").collect()
    assert {r.k: r.before for r in got} == {k: sum(n for j, n in rows if j < k) for k, _ in rows}


def test_views_take_every_row(spark):
    sf = "/root/testdata/sf0.001"
    orders, items = read(spark, sf, "orders"), read(spark, sf, "lineitem")
    assert view(spark, sf, "network").count() == orders.where("o_custkey <> o_orderkey").select(F.least("o_custkey", "o_orderkey"), F.greatest("o_custkey", "o_orderkey")).distinct().count()
    assert view(spark, sf, "ras").count() == items.selectExpr("l_partkey % 100", "l_orderkey % 100").distinct().count()


def test_names_lose_their_accents(spark):
    df = spark.createDataFrame([("1", "Écluse du-pont"), ("2", "Ñandú #7")], "id string, brand string")
    assert [r.prefix for r in shapes.p23(df).orderBy("id").collect()] == ["EcluseDuPont", "Nandu7"]


def test_links_connect_what_all_pairs_connect(spark):
    rng = np.random.default_rng(11)
    points = spark.createDataFrame([(n, *map(float, np.round(rng.random(2) * 60, 1))) for n in range(180)], "id long, x double, y double")
    every = spatial.within_distance(points, points, 4.0).where("id_a < id_b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    few = spatial.links_within(points, 4.0).localCheckpoint()
    assert sorted(map(tuple, graph.connected_components(few).collect())) == sorted(map(tuple, graph.connected_components(every).collect())) and few.count() < every.count()
