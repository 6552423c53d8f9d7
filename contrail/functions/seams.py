"""Tile seams, geometry of edges and features of boundaries, as Column expressions over normalised scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import clamp01

# Weights, floors and limits of the seam rules.
TILE_WEIGHTS = {"straight": 0.28, "radiometric": 0.27, "texture": 0.10, "rectangular": 0.10, "right_angle": 0.05}
ABSENT_WEIGHT, ANGLE_CAP, SUPPRESS, FLOOR = 0.15, 0.49, 0.45, 0.55
STRICT = {"straight": 0.85, "radiometric": 0.55, "screen_locked": 0.70}
STRICT_BELOW = {"persistence": 0.35, "terrain_shadow": 0.55, "ground": 0.55, "track_line": 0.55, "ui_overlay": 0.55}
MPH_TO_MS, TOLERANCE, AXIS_DEG, STRAIGHT_LEAST, TONE_LEAST = 0.44704, 0.35, 5.0, 0.85, 0.20


def seam_likelihoods(s: dict[str, Column]) -> dict[str, Column]:
    """Likelihoods of a seam, of cloud and terrain shadows and of a ground feature, from the candidate's scores.

    A right angle is weak evidence of itself: without two more signs it holds the seam below one half; what the context
    explains lowers it further.
    """
    signs = [s[k] >= 0.55 for k in ("straight", "radiometric", "texture", "rectangular")] + [s[k] <= 0.35 for k in ("persistence", "terrain")]
    count = sum((c.cast("int") for c in signs), F.lit(0))
    base = sum((s[k] * w for k, w in TILE_WEIGHTS.items()), F.lit(0.0)) + (1.0 - s["persistence"]) * ABSENT_WEIGHT + (1.0 - s["terrain"]) * ABSENT_WEIGHT
    base = F.when((s["right_angle"] >= 0.55) & (count < 2), F.least(clamp01(base), F.lit(ANGLE_CAP))).otherwise(clamp01(base))
    hidden = F.greatest(s["cloud"], s["shadow"])
    return {
        "corroborating": count,
        "tile_base": base,
        "tile_seam": clamp01(base * (1.0 - SUPPRESS * s["suppression"])),
        "cloud_shadow": clamp01(hidden * F.greatest(s["radiometric"], s["texture"], F.lit(0.1))),
        "terrain_shadow": clamp01(s["terrain"] * F.greatest(s["shadow"], s["radiometric"], s["texture"])),
        "ground": clamp01((s["persistence"] + s["infrastructure"] + s["suppression"] + (1.0 - hidden)) / 4.0),
    }


def seam_decision(suppression: Column, right_angle: Column) -> Column:
    """The likeliest explanation (columns of `seam_likelihoods`), the first of equals, none below the floor."""
    names = ("tile_seam", "cloud_shadow", "terrain_shadow", "ground")
    best = F.greatest(*[F.col(n) for n in names])
    choice = F.lit(None).cast("string")
    for n in reversed(names):
        choice = F.when(F.col(n) == best, "probable_" + n.replace("ground", "ground_feature")).otherwise(choice)
    explained = (suppression >= 0.70) & (right_angle >= 0.55) & (F.col("tile_base") >= 0.45)
    return F.when(explained, "explainable_infrastructure").when(best < FLOOR, "indeterminate").otherwise(choice)


def strict_decision(s: dict[str, Column]) -> Column:
    """A seam only if all clauses hold; else the overlap that explains it."""
    clauses = [s[k] >= v for k, v in STRICT.items()] + [s[k] < v for k, v in STRICT_BELOW.items()]
    every = clauses[0]
    for c in clauses[1:]:
        every = every & c
    return F.when(every, "probable_tile_seam").when(s["track_line"] >= 0.55, "probable_track_line").when(s["ui_overlay"] >= 0.55, "probable_ui_overlay").otherwise("indeterminate")


def coherent_shift(shift_m: Column, speed_mph: Column, seconds: Column) -> Column:
    """Whether a shift between frames is what the platform's motion makes expect; without motion it is."""
    expected = speed_mph * MPH_TO_MS * seconds
    ratio = F.greatest(F.lit(0.0), shift_m) / F.when(expected > 0, expected)
    return F.coalesce(ratio.between(1.0 - TOLERANCE, 1.0 + TOLERANCE), F.lit(True))


def on_axis(degrees: Column) -> tuple[Column, Column]:
    """(horizontal, vertical) within the tolerance."""
    angle = F.abs(degrees) % 180.0
    return (angle <= AXIS_DEG) | (angle >= 180.0 - AXIS_DEG), F.abs(angle - 90.0) <= AXIS_DEG


def seam_edge(straight: Column, tone: Column, degrees: Column, shift_m: Column, speed_mph: Column, seconds: Column) -> tuple[Column, Column]:
    """(is a seam's edge, confidence): straight, on an axis, with a step in tone, and locked to the screen in motion."""
    across, up = on_axis(degrees)
    locked = (speed_mph * seconds > 0) & ~coherent_shift(shift_m, speed_mph, seconds)
    fits = (across | up) & locked
    return fits & (straight >= STRAIGHT_LEAST) & (tone >= TONE_LEAST), F.when(fits, clamp01(straight) * clamp01(tone)).otherwise(0.0)


def terrain_crossing(variance: Column, deviation: Column, hillshade: Column) -> Column:
    """High where the ground changes under a line that stays straight and that the hills do not explain."""
    return clamp01(clamp01(0.65 * clamp01(variance) + 0.35 * clamp01(1.0 - deviation)) * (1.0 - clamp01(hillshade)))


def landcover_persistence(classes: Column, continuity: Column) -> Column:
    return clamp01(0.55 * clamp01((F.greatest(classes, F.lit(1)) - 1) / 4.0) + 0.45 * continuity)


def radiometric_contrast(left: Column, right: Column, left_sd: Column, right_sd: Column) -> Column:
    """Difference of means over three pooled deviations; without spread the plain difference."""
    pooled = F.sqrt((F.pow(F.greatest(left_sd, F.lit(0.0)), 2) + F.pow(F.greatest(right_sd, F.lit(0.0)), 2)) / 2.0)
    gap = F.abs(left - right)
    return F.when(pooled <= 0, clamp01(gap)).otherwise(clamp01(gap / (F.when(pooled > 0, pooled) * 3.0)))


ROAD, BUILDING, AIRPORT, PARCEL = 0.30, 0.25, 0.25, 0.20


def infrastructure_alignment(road: Column, building: Column, airport: Column, parcel: Column) -> Column:
    return clamp01(ROAD * clamp01(road) + BUILDING * clamp01(building) + AIRPORT * clamp01(airport) + PARCEL * clamp01(parcel))


def step_down(value: Column, steps: list[tuple[float, float]], rest: float) -> Column:
    """The first step's score whose limit the value does not exceed."""
    out = F.lit(rest)
    for limit, score in reversed(steps):
        out = F.when(value <= limit, score).otherwise(out)
    return out
