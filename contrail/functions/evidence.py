"""Evidence scores: sums of governed weights over signal and link maps."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import clamp01

# The weights of each family's signals and links.
WEIGHTS: dict[str, tuple[dict[str, float], dict[str, float]]] = {
    "patchwork": (
        {
            "LOW_CANOPY_MANAGED_SURFACE": 0.20,
            "DIRT_SERVICE_ROAD_NETWORK": 0.25,
            "PATCH_BOUNDARY_GEOMETRY": 0.11,
            "ROAD_END_TURNAROUND": 0.20,
            "CUT_FILL_EXPOSURE": 0.15,
            "INFRASTRUCTURE_ADJACENCY": 0.10,
            "REPEAT_FR24_GRID_PROXIMITY": 0.30,
        },
        {"FR24_ROUTE_PROXIMITY": 0.10, "ADS_B_GAP": 0.10, "LOITER_HOVER": 0.10, "REPEAT_GRIDID": 0.10},
    ),
    "road_end": (
        {
            "DEAD_END": 0.20,
            "BULB_LOOP": 0.25,
            "WIDENED_SERVICE_PAD": 0.25,
            "PULL_OFF": 0.15,
            "SWITCHBACK_TERMINUS": 0.15,
        },
        {"PATCHWORK_POI": 0.10, "FR24_ROUTE_PROXIMITY": 0.10, "ADS_B_GAP": 0.10, "REPEAT_GRIDID": 0.10},
    ),
    "cut_fill": (
        {
            "EXCAVATION_FACE": 0.25,
            "GRADED_PAD": 0.20,
            "SPOIL_PILE": 0.15,
            "BORROW_PIT": 0.20,
            "TERRACE_SCARP": 0.15,
            "RETAINING_FILL": 0.15,
        },
        {
            "PATCHWORK_POI": 0.10,
            "ROAD_END_NODE": 0.10,
            "FR24_ROUTE_PROXIMITY": 0.10,
            "ADS_B_GAP": 0.10,
            "REPEAT_GRIDID": 0.10,
        },
    ),
    "corridor": (
        {
            "VEGETATION_BREAK": 0.08,
            "UNPAVED_LINEAR_CLEARING": 0.08,
            "UTILITY_EASEMENT": 0.06,
            "SERVICE_TRACK": 0.06,
            "DRAINAGE_CORRIDOR": 0.06,
            "FENCE_OR_BOUNDARY_STRIP": 0.05,
            "CONTINUITY": 0.12,
            "LINEARITY": 0.12,
            "WIDTH_CONSISTENCY": 0.08,
            "EDGE_DEFINITION": 0.06,
            "VEGETATION_CONTRAST": 0.05,
            "SURFACE_CONTRAST": 0.05,
            "JUNCTION_OR_TERMINUS_EVIDENCE": 0.06,
            "VISIBLE_ASSET_SUPPORT": 0.05,
            "RECURRENCE": 0.06,
        },
        {"PATCHWORK_POI": 0.03, "ROAD_END_NODE": 0.05, "CUT_FILL_FEATURE": 0.04, "REPEAT_GRIDID": 0.05},
    ),
    "water": (
        {
            "PERMANENT_POND": 0.06,
            "RETENTION_BASIN": 0.06,
            "DETENTION_BASIN": 0.05,
            "SEASONAL_WATER": 0.04,
            "EXCAVATED_WATER_BODY": 0.06,
            "SPILLWAY": 0.04,
            "DRAINAGE_OUTLET": 0.04,
            "BERM": 0.04,
            "WATER_SURFACE_VISIBILITY": 0.14,
            "SHORELINE_CONTINUITY": 0.10,
            "BASIN_GEOMETRY": 0.09,
            "EXCAVATION_EVIDENCE": 0.07,
            "BERM_CONTINUITY": 0.06,
            "INLET_OUTLET_VISIBILITY": 0.05,
            "SPILLWAY_EVIDENCE": 0.04,
            "VEGETATION_MOISTURE_CONTRAST": 0.03,
            "RECURRENCE": 0.03,
        },
        {"PATCHWORK_POI": 0.02, "ROAD_END_NODE": 0.03, "CUT_FILL_FEATURE": 0.04, "LINEAR_CORRIDOR": 0.03, "REPEAT_GRIDID": 0.04},
    ),
    "artifact": (
        {
            "TILE_SEAM": 0.25,
            "ORTHO_MOSAIC_BOUNDARY": 0.20,
            "BLUR_EDGE": 0.15,
            "EPOCH_MISMATCH": 0.20,
            "COLOR_BALANCE_SHIFT": 0.15,
            "PARALLAX_OFFSET": 0.15,
            "CROSSES_UNRELATED_TERRAIN": 0.10,
            "CANDIDATE_BOUNDARY_COINCIDENCE": 0.10,
        },
        {"PATCHWORK_POI": 0.05, "ROAD_END_NODE": 0.05, "CUT_FILL_FEATURE": 0.05},
    ),
}


@dataclass(frozen=True)
class Family:
    """A family of detectors: weights by signal and by link, whether contributions are rounded before they are summed, and whether
    the band is that of the score less artifacts."""

    signals: dict[str, float]
    links: dict[str, float] = field(default_factory=dict)
    rounded: bool = True
    adjusted_band: bool = False


FAMILIES = {k: Family(*v, rounded=k != "water", adjusted_band=k in ("corridor", "water")) for k, v in WEIGHTS.items()}


def signal_score(signals: Column, family: Family) -> Column:
    """Sum of weight times clamped presence, each rounded to 4 places where the family does; unknown signals count nothing."""
    parts = [F.coalesce(clamp01(F.element_at(signals, k)), F.lit(0.0)) * w for k, w in family.signals.items()]
    if family.rounded:
        parts = [F.bround(p, 4) for p in parts]
    return F.bround(clamp01(sum(parts[1:], parts[0])), 4)


def link_score(links: Column, family: Family) -> Column:
    """Sum of the weights of the links that are present."""
    parts = [F.when(F.element_at(links, k), w).otherwise(0.0) for k, w in family.links.items()]
    return F.bround(clamp01(sum(parts[1:], parts[0])), 4)


def combined_score(signals: Column, links: Column, family: Family) -> Column:
    """Clamped sum of signal and link scores."""
    return F.bround(clamp01(signal_score(signals, family) + link_score(links, family)), 4)


def discounted(score: Column, artifact: Column) -> Column:
    """A score less up to half of it for image artifacts."""
    return F.bround(F.round(clamp01(score * (1.0 - 0.5 * clamp01(artifact))), 9), 4)  # no tie is lost to the last binary digit


def review_reasons(adjusted: Column, artifact: Column, classes: Column, signals: Column) -> Column:
    """Why a water feature goes to review, in order: many artifacts, a low score, no known class, no signals."""
    reasons = {
        "HIGH_ARTIFACT_CONFIDENCE": artifact >= 0.7,
        "LOW_ADJUSTED_CONFIDENCE": adjusted < 0.40,
        "NO_VISIBLE_SIGNAL_VALUES": F.coalesce(F.size(signals), F.lit(0)) <= 0,
        "UNKNOWN_WATER_CLASS": F.coalesce(F.size(classes), F.lit(0)) <= 0,
    }
    return F.array_compact(F.array(*[F.when(c, k) for k, c in reasons.items()]))


def available_mean(parts: list[tuple[Column, float]], penalty: float = 0.05, most: float = 0.35) -> tuple[Column, Column]:
    """(weighted mean over the parts that are not null, penalty for those that are)."""
    top = sum((F.coalesce(c * w, F.lit(0.0)) for c, w in parts), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in parts), F.lit(0.0))
    missing = sum((c.isNull().cast("int") for c, _ in parts), F.lit(0))
    mean = F.when(weight == 0, 0.0).otherwise(top / F.when(weight == 0, 1.0).otherwise(weight))
    return F.bround(clamp01(mean), 4), F.bround(F.least(F.lit(most), missing * penalty), 4)
