"""Shapes of tracks from their points, and hashes of pictures from their pixels, by grouped sums."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuts import cut

# Points of a component that counts, sectors around its middle and the share of them that closes a shape, how hollow a
# ring is at least, how even an orbit's and how thin a line's points are at most, and the trust in what pictures alone say.
LEAST_POINTS, SECTORS, CLOSED, HOLLOW, EVEN, THIN, TRUST = 30, 36, 0.9, 0.25, 0.25, 0.05, 0.6


def component_shapes(points: DataFrame, key: list[str]) -> DataFrame:
    """Rows (`key`, points, axis_ratio, extent, coverage, mean_r, rel_std, hollow, shape, length) of groups of points (x, y): how thin
    a group is, how long along its main axis, and how its points lie in sectors and rings around their middle.

    Points are summed by group, then measured from the group's middle and axis, and summed again; no group is held in a task
    but for the distinct distances of its points.
    """
    sums = points.groupBy(*key).agg(
        F.count("*").alias("points"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.var_pop("x").alias("a"), F.var_pop("y").alias("c"), F.covar_pop("x", "y").alias("b")
    )
    root = F.hypot((F.col("a") - F.col("c")) / 2, F.col("b"))
    half = (F.col("a") + F.col("c")) / 2
    turned = F.atan2(2 * F.col("b"), F.col("a") - F.col("c")) / 2
    ratio = F.when(half + root > 0, F.greatest(F.lit(0.0), half - root) / (half + root)).otherwise(1.0)
    axes = cut(sums.select(*key, "points", "cx", "cy", ratio.alias("axis_ratio"), F.cos(turned).alias("ux"), F.sin(turned).alias("uy")))
    dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    sector = F.least(F.lit(SECTORS - 1), F.floor((F.atan2(dy, dx) + math.pi) / (2 * math.pi) * SECTORS))
    placed = points.join(axes, key).select(*key, F.hypot(dx, dy).alias("r"), (dx * F.col("ux") + dy * F.col("uy")).alias("p"), sector.alias("sector"))
    rings = placed.groupBy(*key).agg(
        (F.max("p") - F.min("p")).alias("extent"), (F.size(F.collect_set("sector")) / SECTORS).alias("coverage"), F.avg("r").alias("mean_r"),
        F.stddev_pop("r").alias("_sd"), F.percentile("r", F.lit(0.05)).alias("_low"), F.max("r").alias("_high"),
    )
    met = axes.join(rings, key).withColumns({"rel_std": F.when(F.col("mean_r") > 0, F.col("_sd") / F.col("mean_r")).otherwise(1.0), "hollow": F.when(F.col("_high") > 0, F.col("_low") / F.col("_high")).otherwise(0.0)})
    closed = (F.col("coverage") >= CLOSED) & (F.col("hollow") >= HOLLOW)
    shape = F.when(closed & (F.col("rel_std") <= EVEN), "orbit").when(closed, "loop").when(F.col("axis_ratio") <= THIN, "linear").otherwise("curve")
    length = F.when(closed, 2 * math.pi * F.col("mean_r")).otherwise(F.col("extent"))
    return met.select(*key, "points", "axis_ratio", "extent", "coverage", "mean_r", "rel_std", "hollow", shape.alias("shape"), length.alias("length"))


def track_features(points: DataFrame, key: list[str], component: str, least: int = LEAST_POINTS) -> DataFrame:
    """Rows (`key`, path_shape, has_loop, has_orbit, has_gap, track_length, left, top, width, height, components, confidence) of pictures whose
    track is points (x, y) in components; smaller components than `least` are noise. The largest component, the first of
    equals, gives the shape."""
    shapes = component_shapes(points, [*key, component]).where(F.col("points") >= least)
    boxes = points.groupBy(*key, component).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    first = F.max_by("shape", F.struct("points", F.struct(-F.col(component).cast("double")))).alias("path_shape")
    met = shapes.join(boxes, [*key, component]).groupBy(*key).agg(
        first, F.count("*").alias("components"), F.round(F.sum("length"), 1).alias("track_length"), F.min("x0").alias("left"), F.min("y0").alias("top"),
        (F.max("x1") + 1 - F.min("x0")).alias("width"), (F.max("y1") + 1 - F.min("y0")).alias("height"),
    )
    flag = lambda c: c.cast("int")
    return met.withColumns({"has_loop": flag(F.col("path_shape").isin("loop", "orbit")), "has_orbit": flag(F.col("path_shape") == "orbit"), "has_gap": flag(F.col("components") >= 2), "confidence": F.lit(TRUST)})


def average_hash(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Rows (`key`, hash): 64 bits in hexadecimal digits, one for each of 8 by 8 blocks of grey pixels (x, y, grey, from 0), set
    where the block is as bright as all blocks on average or brighter. A block of a picture of fewer than eight rows or
    columns holds the nearest one. Means are decimals to 15 places, summed exactly and equal within 1e-12, so that a block just as
    bright as all counts in any order of the rows; those of pictures of up to 4,000 by 4,000 whole greys differ by more."""
    sizes = pixels.groupBy(*key).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    blocks = F.sequence(F.lit(0), F.lit(7))

    def of(at: str, size: str) -> Column:
        low = lambda b: F.floor(b * F.col(size) / 8)
        return F.filter(blocks, lambda b: (F.col(at) >= low(b)) & (F.col(at) < F.greatest(low(b) + 1, low(b + 1))))

    placed = pixels.join(sizes, key).withColumn("_by", F.explode(of("y", "_h"))).withColumn("_bx", F.explode(of("x", "_w")))
    grey, n = F.sum(F.col("grey").cast("decimal(14,4)")), F.count("grey").cast("decimal(10,0)")
    cells = placed.groupBy(*key, "_by", "_bx").agg((grey / n).alias("_c"), (64 * grey / n).alias("_c64"))
    whole = cells.groupBy(*key).agg(F.sum("_c").alias("_total"))  # blocks without pixels are black
    bit = F.when(F.col("_c64") + F.lit("0.000000000001").cast("decimal(12,12)") >= F.col("_total"), F.call_function("shiftleft", F.lit(1).cast("long"), (63 - F.col("_by") * 8 - F.col("_bx")).cast("int"))).otherwise(F.lit(0).cast("long"))
    dark = F.when(F.max("_total") <= 0, F.lit(-1).cast("long")).otherwise(F.bit_or(bit))
    return cells.join(whole, key).groupBy(*key).agg(F.lower(F.lpad(F.hex(dark), 16, "0")).alias("hash"))


def circular_mean(degrees: Column, weight: Column) -> Column:
    """The mean of angles as directions, weighed, from 0 up to 360; 0 where they cancel out."""
    x, y = F.sum(weight * F.cos(F.radians(degrees))), F.sum(weight * F.sin(F.radians(degrees)))
    return F.when((x == 0) & (y == 0), 0.0).otherwise((F.round(F.degrees(F.atan2(y, x)), 6) + 360.0) % 360.0)


def hue_gap(a: Column, b: Column) -> Column:
    """How far two hues lie apart on the circle, at most 180."""
    apart = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(apart, 360.0 - apart)
