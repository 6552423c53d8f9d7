"""Measures of heights on a grid, as functions of arrays; missing cells are NaN, and edges repeat their nearest cell."""

from __future__ import annotations

import numpy as np

#: Horn's weights for a derivative, and second differences, by rows to the north and columns to the east.
EAST = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]]) / 8
NORTH = np.array([[-1, -2, -1], [0, 0, 0], [1, 2, 1]]) / 8
EAST_EAST = np.array([[0, 0, 0], [1, -2, 1], [0, 0, 0]])
NORTH_NORTH = np.array([[0, 1, 0], [0, -2, 0], [0, 1, 0]])
EAST_NORTH = np.array([[1, 0, -1], [0, 0, 0], [-1, 0, 1]]) / 4


def around(grid: np.ndarray, reach: int = 1) -> list[list[np.ndarray]]:
    """The grid shifted to each place of a window: [row][column] gives every cell's neighbour there."""
    wide = np.pad(grid, reach, mode="edge")
    n, m = grid.shape
    return [[wide[i : i + n, j : j + m] for j in range(2 * reach + 1)] for i in range(2 * reach + 1)]


def weighed(grid: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted sum over each cell's window. Missing cells lend their share of weight to the others; a missing cell, and one beside
    it, has none."""
    missing = np.isnan(grid)
    places = [(w, a) for ws, row in zip(weights, around(np.where(missing, 0.0, grid)), strict=True) for w, a in zip(ws, row, strict=True)]
    total = sum(w * a for w, a in places)
    if not missing.any():
        return total
    there = sum(abs(w) * a for w, a in zip(weights.ravel(), [a for row in around((~missing).astype(float)) for a in row], strict=True))
    out = np.where(there > 0, total / np.where(there > 0, there, 1.0) * np.abs(weights).sum(), np.nan)
    wide = np.pad(missing, 1)
    out[missing | wide[:-2, 1:-1] | wide[2:, 1:-1] | wide[1:-1, :-2] | wide[1:-1, 2:]] = np.nan
    return out


def slopes(grid: np.ndarray, dx: float, dy: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slope in degrees, rise to the east, rise to the north) for cells of dx by dy metres."""
    east, north = weighed(grid, EAST / dx), weighed(grid, NORTH / dy)
    return np.degrees(np.arctan(np.hypot(east, north))), east, north


def curvatures(grid: np.ndarray, dx: float, dy: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(profile, plan, general) curvature: along the slope, across it, and of the surface; the first two are 0 where no slope is known."""
    _, e, n = slopes(grid, dx, dy)
    ee, nn, en = weighed(grid, EAST_EAST / dx**2), weighed(grid, NORTH_NORTH / dy**2), weighed(grid, EAST_NORTH / (dx * dy))
    steep = e**2 + n**2
    sloped = np.where(steep > 0, steep, 1.0)
    profile = np.where(steep > 0, -(ee * e**2 + 2 * en * e * n + nn * n**2) / (sloped * (steep + 1) ** 1.5), 0.0)
    plan = np.where(steep > 0, -(ee * n**2 - 2 * en * e * n + nn * e**2) / sloped**1.5, 0.0)
    return profile, plan, -(ee + nn)


def roughness(grid: np.ndarray, window: int = 3, gaps: bool | None = None) -> np.ndarray:
    """The standard deviation of the heights in each cell's window; of a sample, with the missing left out, if the whole grid has
    gaps, else of all."""
    missing = np.isnan(grid)
    every = lambda a: sum(x for row in around(a, window // 2) for x in row)
    middle = np.nanmean(grid) if not missing.all() else 0.0  # differences from it keep the squares small
    near = np.where(missing, 0.0, grid - middle)
    n = every((~missing).astype(float))
    total, squares = every(near), every(near**2)
    if not (missing.any() if gaps is None else gaps):
        return np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0.0))
    spread = np.where(n > 1, (squares - total**2 / np.maximum(n, 1)) / np.maximum(n - 1, 1), 0.0)
    return np.where(missing, np.nan, np.sqrt(np.maximum(spread, 0.0)))


def area_ratio(grid: np.ndarray, dx: float, dy: float) -> np.ndarray:
    """Area of the surface over that of its cell."""
    _, east, north = slopes(grid, dx, dy)
    return np.sqrt(1 + east**2 + north**2)


def ruggedness(grid: np.ndarray, dx: float, dy: float, window: int = 3) -> np.ndarray:
    """How far the surface's normals in a window point apart: 0 where they agree, up to 1."""
    _, east, north = slopes(grid, dx, dy)
    length = np.sqrt(east**2 + north**2 + 1)
    sums = [sum(a for row in around(v / length, window // 2) for a in row) for v in (-east, -north, np.ones_like(grid))]
    return np.clip(1 - np.sqrt(sum(s**2 for s in sums)) / window**2, 0.0, 1.0)


def ridges(grid: np.ndarray, deepest: float = -200.0) -> np.ndarray:
    """Cells under water, no deeper than `deepest`, that are higher than all four neighbours."""
    wide = np.pad(grid, 1, constant_values=np.nan)
    four = [wide[:-2, 1:-1], wide[2:, 1:-1], wide[1:-1, :-2], wide[1:-1, 2:]]
    return (grid < 0) & (grid >= deepest) & np.all([grid > a for a in four], axis=0)
