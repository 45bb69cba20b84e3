"""Rings with holes into triangles, by cutting ears. One polygon goes to one call, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

Point = tuple[float, float]


def turn(a: Point, b: Point, c: Point) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def signed_area(ring: list[Point]) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1])) / 2


def cleaned(ring: list[Point], against_clock: bool) -> list[Point]:
    """Without repeated neighbours, turned the asked way."""
    out = [p for k, p in enumerate(ring) if p != ring[k - 1]] if len(ring) > 1 else list(ring)
    return out if (signed_area(out) > 0) == against_clock else out[::-1]


def sees(a: Point, b: Point, rings: list[list[Point]]) -> bool:
    """Whether no edge that shares no end with a-b crosses or touches it."""
    for ring in rings:
        for p, q in zip(ring, ring[1:] + ring[:1]):
            if {p, q} & {a, b}:
                continue
            t = turn(a, b, p), turn(a, b, q), turn(p, q, a), turn(p, q, b)
            if t[0] * t[1] <= 0 and t[2] * t[3] <= 0:
                return False
    return True


def joined(outer: list[Point], holes: list[list[Point]]) -> list[Point]:
    """One ring: each hole, the easternmost first, is joined by a bridge to a corner that it sees."""
    ring, left = outer, sorted(holes, key=lambda h: -max(h)[0])
    for n, hole in enumerate(left):
        start = hole.index(max(hole))
        a = hole[start]
        order = sorted(range(len(ring)), key=lambda k: (ring[k][0] - a[0]) ** 2 + (ring[k][1] - a[1]) ** 2)
        k = next((k for k in order if sees(a, ring[k], [ring, *left[n:]])), order[0])
        ring = ring[: k + 1] + hole[start:] + hole[: start + 1] + ring[k:]
    return ring


def ears(outer: list[Point], holes: list[list[Point]] = ()) -> list[tuple[Point, Point, Point]]:
    """Triangles, against the clock, that cover a simple ring less its holes. Flat ones are left out; a ring of no area gives none."""
    outer = cleaned(outer, True)
    if len(outer) < 3 or signed_area(outer) == 0:
        return []
    ring, out = joined(outer, [cleaned(h, False) for h in holes if len(h) > 2]), []
    while len(ring) > 3:
        for k in range(len(ring)):
            a, b, c = ring[k - 1], ring[k], ring[(k + 1) % len(ring)]
            if turn(a, b, c) <= 0:
                continue
            inner = (p for p in ring if p not in (a, b, c))
            if not any(turn(a, b, p) >= 0 and turn(b, c, p) >= 0 and turn(c, a, p) >= 0 for p in inner):
                break
        else:
            # No ear: what is left has flat corners only, or the ring crosses itself.
            k = min(range(len(ring)), key=lambda k: abs(turn(ring[k - 1], ring[k], ring[(k + 1) % len(ring)])))
            a, b, c = ring[k - 1], ring[k], ring[(k + 1) % len(ring)]
        if turn(a, b, c) > 1e-9:
            out.append((a, b, c))
        del ring[k]
    if turn(*ring) > 1e-9:
        out.append(tuple(ring))
    return out


def triangulate(polygons: DataFrame) -> DataFrame:
    """(id, tri, x1, y1, x2, y2, x3, y3) of polygons (id, rings: the outer one, then holes, as arrays of (x, y))."""
    kind = dict(polygons.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for id, rings in zip(b["id"], b["rings"]):
                rings = [] if rings is None else [[(p["x"], p["y"]) for p in r] for r in rings]
                rows += [(id, n, *t[0], *t[1], *t[2]) for n, t in enumerate(ears(rings[0], rings[1:]) if rings else [])]
            yield pd.DataFrame(rows, columns=["id", "tri", "x1", "y1", "x2", "y2", "x3", "y3"])

    return polygons.select("id", "rings").mapInPandas(run, f"id {kind}, tri int, x1 double, y1 double, x2 double, y2 double, x3 double, y3 double")
