"""Faces that share corners, against plain sequential versions."""

import numpy as np
from pyspark.sql import functions as F

from geoloom.operators import rings
from geoloom.operators.lines import keep_mask


def squares(rng, n, bent):
    """A sheet of n x n squares whose sides have three more corners each."""
    at = lambda i, j: (10.0 * i, 10.0 * j)
    sides = {}

    def side(a, b):
        key = (min(a, b), max(a, b))
        if key not in sides:
            (x0, y0), (x1, y1) = (at(*k) for k in key)
            sides[key] = [(round(x0 + t * (x1 - x0) + d * (y1 - y0) / 10, 3), round(y0 + t * (y1 - y0) + d * (x1 - x0) / 10, 3)) for t, d in zip((0.25, 0.5, 0.75), rng.normal(0, bent, 3).tolist())]
        return sides[key] if a < b else sides[key][::-1]

    faces = {}
    for i in range(n):
        for j in range(n):
            around = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
            faces[i * n + j] = [p for k, a in enumerate(around) for p in [at(*a), *side(a, around[(k + 1) % 4])]]
    return faces


def frame(spark, faces):
    return spark.createDataFrame([(f, k, *p) for f, ring in faces.items() for k, p in enumerate(ring)], "face long, seq long, x double, y double")


def straight(faces, tolerance):
    """One pass over all faces, in memory."""
    near = {}
    for ring in faces.values():
        for a, b in zip(ring, ring[1:] + ring[:1]):
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    gone = set()
    for ring in faces.values():
        at = [k for k, p in enumerate(ring) if len(near[p]) != 2]
        for a, b in zip(at, at[1:] + [x + len(ring) for x in at[:1]]) if len(at) > 1 else ():
            run = [ring[k % len(ring)] for k in range(a, b + 1)]
            run = run if run[0] <= run[-1] else run[::-1]
            gone |= {p for p, k in zip(run, keep_mask(np.array(run), tolerance)) if not k}
    while short := [r for r in faces.values() if any(p in gone for p in r) and sum(p not in gone for p in r) < 3]:
        gone -= {p for r in short for p in r}
    return {(f, k) for f, ring in faces.items() for k, p in enumerate(ring) if p not in gone}


def test_straightening_is_the_sequential_one(spark):
    faces = squares(np.random.default_rng(4), 5, 0.3)
    got = {(r.face, r.seq) for r in rings.straighten(frame(spark, faces), 0.3).collect()}
    assert got == straight(faces, 0.3) and 0 < len(got) < sum(map(len, faces.values()))


def test_neighbours_lose_the_same_corners(spark):
    faces = squares(np.random.default_rng(9), 4, 0.2)
    left = {(f, faces[f][k]) for f, k in ((r.face, r.seq) for r in rings.straighten(frame(spark, faces), 0.25).collect())}
    stay = {p for _, p in left}
    assert all((f, p) in left for f, ring in faces.items() for p in ring if p in stay)


def test_a_face_keeps_three_corners(spark):
    """Two faces that meet at both ends of a thin lens: without its bends the lens would be a line."""
    lens = {0: [(0.0, 0.0), (5.0, -0.1), (10.0, 0.0), (5.0, 0.1)], 1: [(0.0, 0.0), (5.0, 0.1), (10.0, 0.0), (10.0, 9.0), (0.0, 9.0)], 2: [(0.0, 0.0), (0.0, -9.0), (10.0, -9.0), (10.0, 0.0), (5.0, -0.1)]}
    got = {(r.face, r.seq) for r in rings.straighten(frame(spark, lens), 1.0).collect()}
    assert got == straight(lens, 1.0) == {(f, k) for f, ring in lens.items() for k in range(len(ring))}


def test_no_faces(spark):
    none = frame(spark, {0: [(0.0, 0.0)]}).where("false")
    assert rings.straighten(none, 1.0).count() == 0
    assert rings.without_hairpins(none, F.lit(True), 10.0, 1.0, 2.0).count() == 0


def test_a_needle_goes_corner_by_corner_and_from_its_neighbour(spark):
    tip = [(4.9, 10.0), (4.95, 15.0), (5.0, 20.0), (5.05, 15.0), (5.1, 10.0)]
    faces = {0: [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), *tip[::-1], (0.0, 10.0)], 1: [(0.0, 10.0), *tip, (10.0, 10.0), (10.0, 30.0), (0.0, 30.0)]}
    got = {(r.face, r.seq) for r in rings.without_hairpins(frame(spark, faces), F.col("face") == 0, 8.0, 9.0, 1.0).collect()}
    gone = {(f, k) for f, ring in faces.items() for k, p in enumerate(ring)} - got
    assert {faces[f][k] for f, k in gone} >= {(5.0, 20.0)} and {faces[0][k] for f, k in gone if f == 0} == {faces[1][k] for f, k in gone if f == 1}
    assert all(rings.is_ring(np.array([p for k, p in enumerate(ring) if (f, k) in got])) for f, ring in faces.items())


def test_a_corner_stays_where_a_face_would_break(spark):
    thin = {0: [(0.0, 0.0), (10.0, 0.0), (10.0, 0.1)]}
    assert rings.without_hairpins(frame(spark, thin), F.lit(True), 8.0, 9.0, 1.0).count() == 3


def test_rings_that_cross_themselves_are_none():
    assert not rings.is_ring(np.array([(0, 0), (10, 10), (10, 0), (0, 10)], float))
    assert not rings.is_ring(np.array([(0, 0), (1, 1)], float))
    assert rings.is_ring(np.array([(0, 0), (10, 0), (10, 10), (0, 10)], float))
