"""Measures over grids in tiles: each tile's task gets its cells and a rim of its neighbours'."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import small

#: Cells along a side of a tile.
SIZE = 256


def by_tiles(cells: DataFrame, measure: Callable[[np.ndarray, bool], dict[str, np.ndarray]], names: list[str], rim: int = 1, size: int = SIZE) -> DataFrame:
    """`measure` of every cell (y, x, z): rows (y, x, `names`), doubles.

    `measure` takes a rectangle of heights, NaN where there is no cell, and whether the whole grid has gaps, and gives a
    rectangle of each name; what it gives for a cell may depend on cells up to `rim` away. A cell is sent to its tile and to
    those that it borders, so a task holds one tile and its rim, whatever the grid's size. Beyond the grid's own edges there is
    nothing, so `measure` meets them as edges. Cells of one place are one, the highest; a null height is a gap.
    """
    ends = cells.agg(*[f(c).alias(f"{n}{c}") for c in "yx" for n, f in (("low", F.min), ("high", F.max))], F.count("z").alias("n")).first()
    if ends["lowy"] is None:
        return cells.select("y", "x", *[F.lit(None).cast("double").alias(n) for n in names]).limit(0)
    gaps = ends["n"] < (ends["highy"] - ends["lowy"] + 1) * (ends["highx"] - ends["lowx"] + 1)
    low, high = {c: ends[f"low{c}"] for c in "yx"}, {c: ends[f"high{c}"] for c in "yx"}

    def tile(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        first, last = ([f(b[c], key[i] * size + at) for i, c in enumerate("yx")] for f, b, at in ((max, low, -rim), (min, high, size - 1 + rim)))
        grid = np.full((last[0] - first[0] + 1, last[1] - first[1] + 1), np.nan)
        part = part.sort_values("z", na_position="first")
        y, x = part["y"].to_numpy() - first[0], part["x"].to_numpy() - first[1]
        grid[y, x] = part["z"].to_numpy(dtype=float, na_value=np.nan)
        own = part.drop_duplicates(["y", "x"], keep="last")
        own = own[(own["y"] // size == key[0]) & (own["x"] // size == key[1])]
        with np.errstate(invalid="ignore", divide="ignore"):
            found = measure(grid, gaps)
        at = own["y"].to_numpy() - first[0], own["x"].to_numpy() - first[1]
        return pd.DataFrame({"y": own["y"], "x": own["x"]} | {n: np.asarray(found[n], float)[at] for n in names})

    near = lambda c: F.array_distinct(F.transform(F.array(F.lit(-rim), F.lit(0), F.lit(rim)), lambda d: F.floor((F.col(c) + d) / size)))
    sent = cells.select(F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.col("z").cast("double").alias("z"))
    sent = sent.withColumn("ty", F.explode(near("y"))).withColumn("tx", F.explode(near("x")))
    made = sent.groupBy("ty", "tx").applyInPandas(tile, "y long, x long, " + ", ".join(f"{n} double" for n in names))
    return made.select("y", "x", *[F.when(~F.isnan(n), F.col(n)).alias(n) for n in names])


def row_profile(cells: DataFrame) -> DataFrame:
    """Mean, least and greatest height of each row of cells; a row with a null has none."""
    whole = F.count("z") == F.count("*")
    return cells.groupBy("y").agg(*[F.when(whole, f("z")).alias(n) for n, f in (("mean_z", F.avg), ("min_z", F.min), ("max_z", F.max))])


def along(cells: DataFrame, start: tuple[float, float], end: tuple[float, float], samples: int, size: float) -> DataFrame:
    """Rows (sample, lat, lon, z): heights at `samples` places, in equal steps, on the straight line between two places (lat, lon), of the
    cell of `size` degrees that holds each; null where there is none."""
    step = F.col("sample") / max(1, samples - 1)
    line = cells.sparkSession.range(samples).withColumnRenamed("id", "sample")
    line = line.select("sample", *[(F.lit(a) + step * (b - a)).alias(c) for c, a, b in zip(("lat", "lon"), start, end, strict=True)])
    placed = line.select("*", F.floor(F.col("lat") / size).alias("y"), F.floor(F.col("lon") / size).alias("x"))
    met = cells.select("y", "x", "z").join(small(placed), ["y", "x"], "right")
    return met.select("sample", "lat", "lon", "z")
