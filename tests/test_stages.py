"""Ears against areas, and the stages without SQL against what they promise."""

import math
import random

import pytest

from geoloom.operators.triangulate import ears, signed_area
from geoloom.plans import catalog

SF = "/root/testdata/sf0.001"


def area(triangles):
    assert all(signed_area(list(t)) > 0 for t in triangles)
    return sum(signed_area(list(t)) for t in triangles)


@pytest.mark.parametrize("seed", range(20))
def test_ears_cover_a_star_less_its_holes(seed):
    rng = random.Random(seed)
    ring = [(r * math.cos(a), r * math.sin(a)) for a, r in [(k * math.tau / 17, rng.uniform(4, 9)) for k in range(17)]]
    holes = [[(x + dx, y + dy) for dx, dy in [(0.5, 0), (0, 0.5), (-0.5, 0), (0, -0.5)]] for x, y in [(1.2, 0), (-1.2, 0.3), (0, -1.5)]]
    ring = ring if seed % 2 else ring[::-1]
    assert area(ears(ring)) == pytest.approx(abs(signed_area(ring)))
    assert area(ears(ring, holes)) == pytest.approx(abs(signed_area(ring)) - 1.5)


def test_rings_without_area():
    assert ears([]) == [] and ears([(0, 0)]) == [] and ears([(0, 0), (1, 0), (2, 0)]) == []
    assert len(ears([(0, 0), (2, 0), (2, 0), (2, 2), (0, 2)])) == 2


def test_terrain_is_whole(spark):
    found = catalog.QUERIES["x1_terrain"](spark, SF).collect()
    assert len(found) == 625 and all(r.z is not None for r in found) and any(r.measured for r in found)


def test_detected_trees_keep_their_distance(spark):
    found = catalog.QUERIES["x4_detected_trees"](spark, SF).collect()
    assert found
    for n, a in enumerate(found):
        for b in found[:n]:
            assert math.hypot(a.x - b.x, a.y - b.y) >= 2 * max(a.crown, b.crown)
