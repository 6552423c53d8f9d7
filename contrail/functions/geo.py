"""Geodesy and small mathematics as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earth radii that the domain's rules use, one for each unit.
RADIUS = {"m": 6_371_000.0, "km": 6371.0088, "nm": 3440.065}


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "km") -> Column:
    """Great-circle distance in metres, kilometres or nautical miles."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * RADIUS[unit]) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def flat_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in metres on a plane of 111 000 metres a degree."""
    return F.hypot((lat2 - lat1) * 111_000.0, (lon2 - lon1) * 111_000.0 * F.cos(F.radians(lat1)))


def segment_nm(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance in nautical miles from a point (x lon, y lat) to the segment a-b, projected on the plane."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length == 0, 0.0).otherwise(((px - ax) * dx + (py - ay) * dy) / F.when(length == 0, 1.0).otherwise(length))
    t = clamp01(t)
    return haversine(py, px, ay + t * dy, ax + t * dx, "nm")


def clamp01(x: Column) -> Column:
    """x within 0..1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def band(score: Column) -> Column:
    """HIGH from 0.70, MEDIUM from 0.40, else LOW."""
    return F.when(score >= 0.70, "HIGH").when(score >= 0.40, "MEDIUM").otherwise("LOW")


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    """Whether a point lies in a box, its edges included."""
    return lat.between(south, north) & lon.between(west, east)


def cell(value: Column, size: float) -> Column:
    """Whole-number cell of a coordinate, truncated towards zero."""
    return (value / F.lit(size)).cast("int")


def near_cell(value: Column, size: float) -> Column:
    """Whole-number cell of a coordinate, rounded half to even."""
    return F.rint(value / F.lit(size)).cast("int")


def tile(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Slippy-map tile (x, y) of a point."""
    n = float(1 << zoom)
    x = F.floor((lon + 180.0) / 360.0 * n).cast("long")
    r = F.radians(lat)
    y = F.floor((1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / F.lit(3.141592653589793)) / 2.0 * n).cast("long")
    return x, y


def to_mph(speed: Column, unit: Column) -> Column:
    """A speed in miles an hour; knots are converted, other units stay."""
    return F.when(F.lower(unit).isin("kt", "kts", "knots"), speed * 1.15078).otherwise(speed)


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Whether a place lies in a polygon, given as its rings of (x, y), holes among them: by how many edges a ray to the east
    crosses. A place on an edge, be it of a hole, is inside. Rings may repeat their first place at the end or not."""

    def edges(ring: Column) -> Column:
        closed = F.concat(ring, F.slice(ring, 1, 1))
        return F.transform(F.sequence(F.lit(0), F.size(ring) - 1), lambda i: F.struct(F.get(closed, i).alias("a"), F.get(closed, i + 1).alias("b")))

    def side(e: Column) -> Column:
        return (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])

    def crosses(e: Column) -> Column:
        up = e["b"]["y"] > e["a"]["y"]
        return ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & F.when(up, side(e) > 0).otherwise(side(e) < 0)

    def on(e: Column) -> Column:
        spans = lambda p, c: p.between(F.least(e["a"][c], e["b"][c]), F.greatest(e["a"][c], e["b"][c]))
        return (side(e) == 0) & spans(x, "x") & spans(y, "y")

    every = F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), edges))
    return F.exists(every, on) | (F.size(F.filter(every, crosses)) % 2 == 1)
