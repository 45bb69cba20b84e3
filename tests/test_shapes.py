"""Greedy selections, line shapes and clips against plain sequential versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.operators import greedy, lines, mesh
from geoloom.plans import catalog
from geoloom.plans.shapes import national_grid
from geoloom.sources.views import view

SF = "/root/testdata/sf0.001"


def test_spacing_is_the_sequential_greedy(spark):
    rng = np.random.default_rng(5)
    rows = [(n, *map(float, np.round(rng.random(2) * 60, 1)), float(rng.integers(1, 9)), float(rng.integers(0, 5))) for n in range(300)]
    got = {r.id for r in greedy.spaced(spark.createDataFrame(rows, "id long, x double, y double, reach double, h double"), "reach", 8.0, [-F.col("h")]).collect()}
    kept = []
    for r in sorted(rows, key=lambda r: (-r[4], r[0])):
        if all(math.hypot(r[1] - k[1], r[2] - k[2]) >= max(r[3], k[3]) for k in kept):
            kept.append(r)
    assert got == {k[0] for k in kept} and 0 < len(got) < 300


def test_a_reach_over_the_bound_is_an_error(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 9.0), (2, 1.0, 0.0, 1.0)], "id long, x double, y double, reach double")
    with pytest.raises(Exception, match="over 8"):
        greedy.spaced(points, "reach", 8.0, [F.col("x")]).collect()


def test_best_pairs_are_the_sequential_greedy(spark):
    rng = np.random.default_rng(6)
    rows = sorted({(int(a), int(b)): (int(a), int(b), float(s)) for a, b, s in zip(rng.integers(0, 40, 150), rng.integers(40, 80, 150), rng.integers(0, 6, 150))}.values())
    got = {(r.a, r.b) for r in greedy.best_pairs(spark.createDataFrame(rows, "a long, b long, score double")).collect()}
    used, want = set(), set()
    for a, b, _ in sorted(rows, key=lambda r: (r[2], r[0], r[1])):
        if not {a, b} & used:
            used |= {a, b}
            want.add((a, b))
    assert got == want


def test_conflict_free_on_a_path_and_without_conflicts(spark):
    nodes = spark.createDataFrame([(n,) for n in range(7)], "id long")
    path = spark.createDataFrame([(n, n + 1) for n in range(6)] + [(3, 3), (5, 99)], "a long, b long")
    assert sorted(r.id for r in greedy.conflict_free(nodes, path, []).collect()) == [0, 2, 4, 6]
    assert greedy.conflict_free(nodes, path.where("false"), []).count() == 7


def test_spurs_go_and_long_ends_stay(spark):
    edges = spark.createDataFrame([(1, 2, 9.0), (2, 3, 9.0), (3, 1, 9.0), (3, 4, 2.0), (4, 5, 1.0), (1, 6, 8.0)], "a long, b long, length double")
    assert sorted((r.a, r.b) for r in greedy.prune_spurs(edges, 5.0).collect()) == [(1, 2), (1, 6), (2, 3), (3, 1)]


def test_simplified_lines_stay_within_the_tolerance(spark):
    source = view(spark, SF, "lines")
    kept = {}
    for r in catalog.QUERIES["p27_simplify"](spark, SF).collect():
        kept.setdefault(r.line, set()).add(r.vertex)
    whole = {}
    for r in source.collect():
        whole.setdefault(r.line, []).append((r.vertex, r.x, r.y))
    assert set(kept) == set(whole)
    for line, points in whole.items():
        points.sort()
        assert {points[0][0], points[-1][0]} <= kept[line]
        held = [k for k, p in enumerate(points) if p[0] in kept[line]]
        for i, j in zip(held, held[1:]):
            a, d = np.array(points[i][1:]), np.array(points[j][1:]) - np.array(points[i][1:])
            for p in points[i + 1 : j]:
                t = np.clip((np.array(p[1:]) - a) @ d / (d @ d), 0, 1) if d @ d else 0
                assert np.hypot(*(np.array(p[1:]) - a - t * d)) <= 120 + 1e-9


def test_simplify_of_one_and_of_equal_vertices():
    assert lines.keep_mask(np.zeros((0, 2)), 1).tolist() == []
    assert lines.keep_mask(np.zeros((1, 2)), 1).tolist() == [True]
    assert lines.keep_mask(np.array([[0, 0], [5, 0], [0, 0]], float), 1).tolist() == [True, True, True]


def test_clipped_rings(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    rows = [(1, ring), (2, [(x + 10, y) for x, y in ring]), (3, [(x / 4 + 1.5, y / 4 + 1.5) for x, y in ring])]
    df = spark.createDataFrame(rows, "id long, ring array<struct<x:double,y:double>>")
    got = {r.id: r.area for r in lines.clip_to_box(df, "ring", 1.0, 1.0, 3.0, 9.0).select("id", lines.ring_area("ring").alias("area")).collect()}
    assert got[1] == pytest.approx(6.0) and got[3] == pytest.approx(1.0) and got[2] == 0


def test_grid_of_known_places(spark):
    at = spark.createDataFrame([(52.15517440, 5.38720621), (52.37453253, 4.88352559)], "la double, lo double")
    got = [(r.x, r.y) for r in at.select(*[c.alias(n) for c, n in zip(national_grid(F.col("la"), F.col("lo")), "xy")]).collect()]
    assert got[0] == (155000.0, 463000.0)
    assert got[1] == (pytest.approx(120700.723, abs=0.5), pytest.approx(487525.501, abs=0.5))


def test_plane_split_keeps_the_area(spark):
    tris = spark.createDataFrame([(n, 0.0, 0.0, z[0], 4.0, 0.0, z[1], 0.0, 4.0, z[2]) for n, z in enumerate([(0.0, 0.0, 0.0), (9.0, 9.0, 9.0), (0.0, 9.0, 9.0), (0.0, 0.0, 9.0), (5.0, 0.0, 9.0)])], "tri long, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double, x3 double, y3 double, z3 double")
    area = F.expr("abs((q.x - p.x) * (s.y - p.y) - (s.x - p.x) * (q.y - p.y)) / 2")
    got = {r.tri: (r.n, round(r.area, 9)) for r in mesh.split(tris, 5.0).groupBy("tri").agg(F.count("*").alias("n"), F.sum(area).alias("area")).collect()}
    assert got == {0: (1, 8.0), 1: (1, 8.0), 2: (3, 8.0), 3: (3, 8.0), 4: (3, 8.0)}


@pytest.mark.parametrize("hits", [16, 0.5])
def test_nearest_segments_are_those_of_all_pairs(spark, monkeypatch, hits):
    """Flat, nearly flat, upright and slanted ones, and one without length, around nought; nulls and empty tables give nothing."""
    monkeypatch.setattr(lines, "HITS", hits)
    rng = np.random.default_rng(9)
    segs = [(n, *map(float, np.round(rng.random(4) * 300 - 150, 1))) for n in range(40)]
    segs += [(50, -90.0, 7.0, 120.0, 7.0), (51, -90.0, -41.0, 120.0, -41.0 + 1e-7), (52, 33.0, 140.0, 33.0, -140.0), (53, 5.0, 5.0, 5.0, 5.0), (54, 120.0, 7.5, -90.0, 7.5), (49, 33.0, 140.0, 33.0, -140.0)]
    points = [(n, *map(float, np.round(rng.random(2) * 400 - 200, 1))) for n in range(500)]
    kinds = "seg long, px double, py double, qx double, qy double", "id long, x double, y double"
    found = lines.nearest_segment(spark.createDataFrame(points + [(900, None, 1.0)], kinds[1]), spark.createDataFrame(segs + [(901, None, 0.0, 1.0, 1.0)], kinds[0]), 8.0).collect()

    def gap(x, y, px, py, qx, qy):
        dx, dy = qx - px, qy - py
        t = min(max(((x - px) * dx + (y - py) * dy) / (dx * dx + dy * dy), 0.0), 1.0) if dx or dy else 0.0
        return math.sqrt((x - px - t * dx) * (x - px - t * dx) + (y - py - t * dy) * (y - py - t * dy))

    want = {n: min((gap(x, y, *s[1:]), s[0]) for s in segs) for n, x, y in points}
    assert {r.id: (r.gap, r.seg) for r in found} == {n: w for n, w in want.items() if w[0] <= 8} and 100 < len(found) < 500
    nothing = spark.createDataFrame([], kinds[0]), spark.createDataFrame([], kinds[1])
    assert lines.nearest_segment(nothing[1], spark.createDataFrame(segs, kinds[0]), 8.0).count() == lines.nearest_segment(spark.createDataFrame(points, kinds[1]), nothing[0], 8.0).count() == 0


def test_crossing_segments(spark):
    segs = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0), (2, 0.0, 9.0, 9.0, 0.0), (3, 0.0, 20.0, 9.0, 20.0), (4, 9.0, 9.0, 20.0, 9.0)], "seg long, px double, py double, qx double, qy double")
    assert [tuple(r) for r in lines.crossings(segs, 2.0).collect()] == [(1, 2)]


def test_pooled_level_gives_each_water_one(spark):
    found = catalog.QUERIES["a6_pooled_level"](spark, SF).collect()
    assert found and sum(r.bodies for r in found) == 150 and all(r.level is not None for r in found)


def test_clips_of_clips_stay_small(spark):
    plan = catalog.QUERIES["p29_polygon_clip"](spark, SF)._jdf.queryExecution().optimizedPlan()
    assert len(plan.toString()) < 50_000


def test_cuts_in_stretches_are_those_of_one_pass(spark, monkeypatch):
    monkeypatch.setattr(greedy, "FIRST", 12)
    monkeypatch.setattr(greedy, "RANKS", 6)
    rng = np.random.default_rng(7)
    rows = [(n, *map(float, rng.integers(0, 40, 4)), int(rng.integers(0, 9))) for n in range(150)]
    segs = spark.createDataFrame(rows, "id long, px double, py double, qx double, qy double, h int")
    named = lambda df: df.withColumnRenamed("id", "seg")
    got = sorted(r.id for r in greedy.in_stretches(segs, lambda a, b: lines.crossing(named(a), named(b), 10.0), [F.col("h")]).collect())
    assert got == sorted(r.id for r in greedy.conflict_free(segs, lines.crossings(named(segs), 10.0), [F.col("h")]).collect()) and 0 < len(got) < 150

def test_stretches_keep_what_one_pass_keeps(spark, monkeypatch):
    monkeypatch.setattr(greedy, "FIRST", 12)
    monkeypatch.setattr(greedy, "RANKS", 6)
    rng = np.random.default_rng(8)
    rows = [(n, *map(float, np.round(rng.random(2) * 60, 0)), float(rng.integers(1, 9)), float(rng.integers(0, 5))) for n in range(400)]
    got = {r.id for r in greedy.spaced(spark.createDataFrame(rows, "id long, x double, y double, reach double, h double"), "reach", 8.0, [-F.col("h")]).collect()}
    kept = []
    for r in sorted(rows, key=lambda r: (-r[4], r[0])):
        if all(math.hypot(r[1] - k[1], r[2] - k[2]) >= max(r[3], k[3]) for k in kept):
            kept.append(r)
    assert got == {k[0] for k in kept}
