"""Tiles that polygons cover, against an exact test of every tile."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from areatab.operators import tiles
from areatab.operators.geo import point_wkb, polygons_wkb


def metres(points, zoom):
    """Tile units -> metres."""
    n = float(1 << zoom)
    return [{"x": (u / n - 0.5) * tiles.WORLD, "y": (0.5 - v / n) * tiles.WORLD} for u, v in points]


def meets(a, b, tx, ty):
    """Whether a point of the segment lies in the tile, its left and upper edges included (exact)."""
    lo, hi, lo_open, hi_open = Fraction(0), Fraction(1), False, False
    for p, d, low in ((a[0], b[0] - a[0], tx), (a[1], b[1] - a[1], ty)):
        for bound, strict, sign in ((low, False, 1), (low + 1, True, -1)):  # sign * (p + t d - bound) >= 0, or > 0
            c, k = sign * (p - bound), sign * d
            if k == 0:
                if c < 0 or (strict and c == 0):
                    return False
            elif k > 0:
                if -c / k > lo or (-c / k == lo and strict):
                    lo, lo_open = -c / k, strict
            elif -c / k < hi or (-c / k == hi and strict):
                hi, hi_open = -c / k, strict
    return lo < hi or (lo == hi and not lo_open and not hi_open)


def inside(rings, u, v):
    odd = False
    for ring in rings:
        for (u1, v1), (u2, v2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (v1 > v) != (v2 > v) and u1 + (v - v1) * (u2 - u1) / (v2 - v1) > u:
                odd = not odd
    return odd


def brute(rings, n):
    """Covered tiles of one feature; rings in tile units."""
    out = set()
    for tx in range(n):
        for ty in range(n):
            edges = [(p, q) for r in rings for p, q in zip(r, r[1:] + r[:1], strict=True)]
            if any(meets(p, q, tx, ty) for p, q in edges) or inside(rings, tx + Fraction(1, 2), ty + Fraction(1, 2)):
                out.add((tx, ty))
    return out


def ring_of(rng, n, k, step):
    return [(Fraction(rng.randrange(0, n * step), step), Fraction(rng.randrange(0, n * step), step)) for _ in range(k)]


@pytest.mark.parametrize("seed", range(40))
def test_every_tile_of_random_polygons(seed):
    rng = random.Random(seed)
    step = rng.choice([1, 2, 8, 64])  # whole numbers put points and crossings on tile corners
    rings = [ring_of(rng, 16, rng.randint(3, 9), step) for _ in range(rng.randint(1, 3))]  # self-crossing ones too
    arrays = [np.array([((float(u) / 16 - 0.5) * 1.0, (0.5 - float(v) / 16) * 1.0) for u, v in r]) for r in rings]
    world, tiles.WORLD = tiles.WORLD, 1.0  # exact in binary
    try:
        _, row, lo, hi = tiles.cover([arrays], 4)
        z, ty, tx, change = tiles.differences([arrays, arrays], 0, 4)
    finally:
        tiles.WORLD = world
    want = brute(rings, 16)
    got = [(x, int(r)) for r, a, b in zip(row, lo, hi, strict=True) for x in range(a, b + 1)]
    assert len(got) == len(set(got)) and set(got) == want
    for zoom in range(5):
        counts = np.zeros((1 << zoom, (1 << zoom) + 1), int)
        own = z == zoom
        counts[ty[own], tx[own]] = change[own]
        up = {(x >> (4 - zoom), y >> (4 - zoom)) for x, y in want}
        found = {(int(x), int(y)): int(n) for y, line in enumerate(np.cumsum(counts, axis=1)) for x, n in enumerate(line) if n}
        assert found == dict.fromkeys(up, 2)


def covered(spark, features, zoom):
    df = spark.createDataFrame([(bytearray(g) if g else None, "clash") for g in features], "geometry binary, tx string")
    return Counter({(r.z, r.tx, r.ty): r.n for r in tiles.tile_cover_polygons(df, max_zoom=zoom).collect()})


def square(u1, v1, u2, v2, zoom):
    return metres([(u1, v1), (u2, v1), (u2, v2), (u1, v2), (u1, v1)], zoom)


def test_holes_parts_repeats_and_other_kinds(spark):
    plain = square(0.5, 0.5, 7.5, 7.5, 3)
    hole = square(2.5, 2.5, 5.5, 5.5, 3)
    two = polygons_wkb([[square(0.1, 0.1, 0.2, 0.2, 3)], [square(0.3, 0.3, 1.2, 0.4, 3)]], srid=3857)
    got = covered(spark, [polygons_wkb([[plain, hole]]), polygons_wkb([[plain, hole]]), two, None, point_wkb(0.0, 0.0), polygons_wkb([[[]]])], 3)
    assert got[(3, 0, 0)] == 3 and got[(3, 1, 0)] == 3 and got[(3, 7, 7)] == 2
    assert (3, 3, 3) not in got and (3, 4, 4) not in got and got[(3, 2, 4)] == 2  # only the hole's middle is free
    assert got[(0, 0, 0)] == 3 and got[(1, 0, 0)] == 3 and got[(1, 1, 1)] == 2
    assert covered(spark, [], 3) == {} and covered(spark, [None], 3) == {}


def test_world_borders(spark):
    over = covered(spark, [polygons_wkb([[square(7.5, 3.2, 8.5, 3.4, 3)]])], 3)  # past 180 degrees
    assert set(over) == {(0, 0, 0), (1, 0, 0), (1, 1, 0), (2, 0, 1), (2, 3, 1), (3, 7, 3), (3, 0, 3)} and set(over.values()) == {1}
    touching = covered(spark, [polygons_wkb([[square(7.5, 3.2, 8, 3.4, 3)]])], 3)
    assert {k for k in touching if k[0] == 3} == {(3, 7, 3)}
    poles = covered(spark, [polygons_wkb([[square(3.5, -2, 3.6, 12, 3)]])], 3)
    assert {k for k in poles if k[0] == 3} == {(3, 3, y) for y in range(8)}
    whole = covered(spark, [polygons_wkb([[square(-20, 0, 20, 8, 3)]])] * 3, 3)
    assert len(whole) == 1 + 4 + 16 + 64 and set(whole.values()) == {3}


def test_large_polygons_shuffle_ranges_not_tiles(spark):
    """A polygon over half the world at zoom 12 is a few changes a row."""
    big = [np.array([(p["x"], p["y"]) for p in square(10.5, 10.5, 2000.5, 4000.5, 12)])]
    z, _, _, change = tiles.differences([big] * 50, 0, 12)
    assert (z == 12).sum() == 2 * 3991 and change.max() == 50
    assert math.isclose(len(z), 2 * 2 * 3991, rel_tol=0.01)


def test_counts_meet_as_partial_sums(spark):
    df = spark.createDataFrame([(bytearray(polygons_wkb([[square(0.5, 0.5, 1.5, 1.5, 3)]])),)], "geometry binary")
    plan = tiles.tile_cover_polygons(df, max_zoom=3)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan and "geometry" not in plan.split("MapInArrow")[0]
