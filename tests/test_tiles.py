"""Measures over tiles against the whole grid, cell by cell."""

import math

import numpy as np
import pytest

from contrail.functions import terrain
from contrail.operators import tiles
from contrail.plans import grids

DX, DY = 400.0, 500.0


def plain(z, dx, dy):
    """All measures cell by cell, with loops; z is a dict of (y, x)."""
    ys, xs = sorted({k[0] for k in z}), sorted({k[1] for k in z})
    low, high = (ys[0], xs[0]), (ys[-1], xs[-1])
    clip = lambda y, x: (min(max(y, low[0]), high[0]), min(max(x, low[1]), high[1]))
    every = [(y, x) for y in range(low[0], high[0] + 1) for x in range(low[1], high[1] + 1)]
    gaps = any(z.get(c) is None for c in every)

    def weighed(c, k):
        beside = [(c[0] + a, c[1] + b) for a, b in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))]
        if any(z.get(n) is None for n in beside if n in grid):
            return math.nan
        near = [(k[i][j], z.get(clip(c[0] + i - 1, c[1] + j - 1))) for i in range(3) for j in range(3)]
        there = sum(abs(w) for w, v in near if v is not None)
        return sum(w * v for w, v in near if v is not None) / there * sum(abs(w) for w, _ in near)

    grid = set(every)
    out, normal = {}, {}
    for c in every:
        e = weighed(c, [[a / (8 * dx) for a in r] for r in ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1))])
        n = weighed(c, [[a / (8 * dy) for a in r] for r in ((-1, -2, -1), (0, 0, 0), (1, 2, 1))])
        length = math.sqrt(1 + e * e + n * n)
        normal[c] = (-e / length, -n / length, 1 / length)
        ee = weighed(c, [[a / dx**2 for a in r] for r in ((0, 0, 0), (1, -2, 1), (0, 0, 0))])
        nn = weighed(c, [[a / dy**2 for a in r] for r in ((0, 1, 0), (0, -2, 0), (0, 1, 0))])
        en = weighed(c, [[a / (4 * dx * dy) for a in r] for r in ((1, 0, -1), (0, 0, 0), (-1, 0, 1))])
        p = e * e + n * n
        near = [z.get(clip(c[0] + i, c[1] + j)) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        v = [a for a in near if a is not None]
        mean = sum(v) / len(v) if v else 0
        spread = sum((a - mean) ** 2 for a in v)
        rough = math.sqrt(spread / (len(v) - 1) if gaps and len(v) > 1 else 0 if gaps else spread / 9)
        four = [z.get((c[0] + a, c[1] + b)) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]
        out[c] = {
            "slope_deg": math.degrees(math.atan(math.hypot(e, n))), "dz_dx": e, "dz_dy": n,
            "profile": -(ee * e * e + 2 * en * e * n + nn * n * n) / (p * (1 + p) ** 1.5) if p > 0 else 0.0,
            "plan": -(ee * n * n - 2 * en * e * n + nn * e * e) / p**1.5 if p > 0 else 0.0,
            "general": -(ee + nn), "roughness": math.nan if z.get(c) is None else rough, "area_ratio": length,
            "ridge": float(z.get(c) is not None and -200 <= z[c] < 0 and all(f is not None and z[c] > f for f in four)),
        }
    for c in every:
        near = [normal[clip(c[0] + i, c[1] + j)] for i in (-1, 0, 1) for j in (-1, 0, 1)]
        out[c]["vrm"] = min(1.0, max(0.0, 1 - math.sqrt(sum(sum(v[i] for v in near) ** 2 for i in range(3))) / 9)) if not any(math.isnan(v[0]) for v in near) else math.nan
    return out


NAMES = ["slope_deg", "dz_dx", "dz_dy", "profile", "plan", "general", "roughness", "area_ratio", "vrm", "ridge"]


def measure(grid, gaps):
    slope = dict(zip(NAMES[:3], terrain.slopes(grid, DX, DY), strict=True)) | dict(zip(NAMES[3:6], terrain.curvatures(grid, DX, DY), strict=True))
    return slope | {"roughness": terrain.roughness(grid, 3, gaps), "area_ratio": terrain.area_ratio(grid, DX, DY), "vrm": terrain.ruggedness(grid, DX, DY), "ridge": terrain.ridges(grid)}


def same(got, want):
    return got is None if math.isnan(want) else got == pytest.approx(want, abs=1e-7)


@pytest.mark.parametrize("gaps", [False, True])
@pytest.mark.parametrize("size", [4, 7, 64])
def test_tiles_equal_plain_loops(spark, gaps, size):
    rng = np.random.default_rng(size)
    z = {(y, x): float(rng.integers(-260, 40)) for y in range(-5, 9) for x in range(-11, 6)}
    for c in [(y, 3) for y in range(-2, 2)]:
        z[c] = -100.0  # flat
    if gaps:
        for c in ((0, 0), (1, 1), (-5, -11), (4, -3)):
            del z[c]
        z[8, 5] = None
    rows = spark.createDataFrame([(y, x, v) for (y, x), v in z.items()], "y long, x int, z double").repartition(5)
    got = {(r["y"], r["x"]): r for r in tiles.by_tiles(rows, measure, NAMES, rim=3, size=size).collect()}
    want = plain(z, DX, DY)
    assert set(got) == set(z)
    for c, r in got.items():
        assert all(same(r[n], want[c][n]) for n in NAMES), (c, r, want[c])


def test_measures_of_the_whole_table_equal_plain_loops(spark, sf):
    z = {(r["y"], r["x"]): r["z"] for r in grids._depths(spark, sf).collect()}
    want = plain(z, grids._DX, grids._DY)
    got = {(r["y"], r["x"]): r for r in grids.terrain_measures(spark, sf).collect()}
    assert set(got) == set(z)
    for c, r in got.items():
        assert all(same(r[n], want[c][n]) for n in NAMES[:9]), (c, r, want[c])


def test_no_cells_have_no_measures(spark):
    none = spark.createDataFrame([], "y long, x long, z double")
    assert tiles.by_tiles(none, measure, NAMES).count() == 0
    assert tiles.along(none, (0.0, 0.0), (1.0, 1.0), 3, 0.5).count() == 3
