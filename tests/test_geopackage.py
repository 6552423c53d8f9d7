"""Geometry of GeoPackages, and places in polygons, against plain versions."""

import random
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThanOrEqual, LessThanOrEqual

from contrail.functions import geo
from contrail.operators import joins
from contrail.sources import geopackage as G

SQUARE = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]


def wkb(code, body, order="<"):
    return struct.pack(f"{order}BI" if order == "<" else ">BI", order == "<", code) + body


def blob(shape, flags=1, head=b""):
    return b"GP\0" + bytes([flags]) + struct.pack("<i", 4326) + head + shape


def ring(points, order="<"):
    return struct.pack(f"{order}I", len(points)) + b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


@pytest.mark.parametrize(
    "raw, want",
    [
        (blob(wkb(1, struct.pack("<2d", 3, 4))), ("point", [[(3, 4)]])),
        (blob(wkb(1, struct.pack(">2d", 3, 4), ">")), ("point", [[(3, 4)]])),
        (blob(wkb(1001, struct.pack("<3d", 3, 4, 9))), ("point", [[(3, 4)]])),
        (blob(wkb(3001, struct.pack("<4d", 3, 4, 9, 8))), ("point", [[(3, 4)]])),
        (blob(wkb(0x80000001, struct.pack("<3d", 3, 4, 9))), ("point", [[(3, 4)]])),
        (blob(wkb(0x20000001, struct.pack("<I2d", 4326, 3, 4))), ("point", [[(3, 4)]])),
        (blob(wkb(1, struct.pack("<2d", np.nan, np.nan)), 0x11), ("point", [])),
        (blob(wkb(2, ring([(0, 0), (1, 5)])), 3, struct.pack("<4d", 0, 1, 0, 5)), ("linestring", [[(0, 0), (1, 5)]])),
        (blob(wkb(3, struct.pack("<I", 2) + ring(SQUARE[0]) + ring(SQUARE[1])), 5, struct.pack("<6d", *range(6))), ("polygon", SQUARE)),
        (blob(wkb(6, struct.pack("<I", 2) + wkb(3, struct.pack("<I", 1) + ring(SQUARE[0])) + wkb(3, struct.pack("<I", 1) + ring(SQUARE[1])))), ("multipolygon", SQUARE)),
        (blob(wkb(7, struct.pack("<I", 2) + wkb(1, struct.pack("<2d", 3, 4)) + wkb(2, ring([(0, 0), (1, 5)])))), ("geometrycollection", [[(3, 4)], [(0, 0), (1, 5)]])),
        (blob(wkb(2, struct.pack("<I", 0))), ("linestring", [])),
    ],
)
def test_geometries_are_decoded(raw, want):
    kind, rings = G.decoded(raw)
    assert (kind, [[tuple(p) for p in r.tolist()] for r in rings]) == want


def test_unknown_geometry_is_an_error():
    with pytest.raises(ValueError, match="simple"):
        G.decoded(blob(wkb(8, b"")))
    with pytest.raises(ValueError, match="GeoPackage"):
        G.decoded(b"XX\0\1" + bytes(20))


def layer(path, rows, indexed):
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('Places', 'shape')")
        db.execute("CREATE TABLE Places (id INTEGER PRIMARY KEY, shape BLOB, name TEXT(20), height DOUBLE, n MEDIUMINT)")
        if indexed:
            db.execute("CREATE VIRTUAL TABLE rtree_Places_shape USING rtree(id, minx, maxx, miny, maxy)")
        for i, (x, y) in rows.items():
            shape = None if x is None else G.encoded("point", [np.array([(x, y)])]) if i % 2 else blob(wkb(1, struct.pack("<2d", x, y)))
            db.execute("INSERT INTO Places VALUES (?, ?, ?, ?, ?)", (i, shape, f"p{i}", i / 2, None if i == 3 else i))
            if indexed and shape:
                db.execute("INSERT INTO rtree_Places_shape VALUES (?, ?, ?, ?, ?)", (i, x, x, y, y))


@pytest.mark.parametrize("indexed", [True, False])
def test_a_layer_is_read_within_a_box(spark, tmp_path, indexed):
    rng = random.Random(1)
    rows = {i: (rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(1, 90)} | {90: (None, None), 95: (0.1, 0.1)}
    layer(str(tmp_path / "a.gpkg"), rows, indexed)
    read = G.read_layer(spark, str(tmp_path), "Places")
    assert read.dtypes[:4] == [("fid", "bigint"), ("name", "string"), ("height", "double"), ("n", "bigint")]
    got = {r["fid"]: r for r in read.collect()}
    assert set(got) == set(rows) and got[3]["n"] is None and got[90]["rings"] is None and got[90]["west"] is None
    assert all((got[i]["rings"][0][0]["x"], got[i]["north"]) == (x, y) for i, (x, y) in rows.items() if x is not None)
    box = {r["fid"] for r in G.within(read, -0.5, 0.1, 0.25, 0.9).collect()}
    assert box == {i for i, (x, y) in rows.items() if x is not None and 0.1 <= x <= 0.9 and -0.5 <= y <= 0.25} and 95 in box
    reader = G._Layer(read.schema, {"path": str(tmp_path), "layer": "Places", "numPartitions": "3"})
    list(reader.pushFilters([LessThanOrEqual(("west",), 0.9), GreaterThanOrEqual(("east",), 0.1)]))
    parts = reader.partitions()
    pushed = [r[0] for p in parts for r in reader.read(p)]
    assert len(parts) == 3 and len(pushed) < len(rows) and box <= set(pushed)


def test_a_missing_layer_or_file_is_an_error(spark, tmp_path):
    layer(str(tmp_path / "a.gpkg"), {1: (0, 0)}, False)
    with pytest.raises(Exception, match="no layer"):
        G.read_layer(spark, str(tmp_path), "none").collect()
    with pytest.raises(Exception, match="no GeoPackage"):
        G.read_layer(spark, str(tmp_path / "none"), "Places").collect()


def plain_inside(x, y, rings):
    """By winding of each ring's edges, with edges inside."""
    odd = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_inside_equals_brute_force_with_holes_and_edges(spark):
    rng = random.Random(3)
    star = [(rng.randint(-8, 8), rng.randint(-8, 8)) for _ in range(9)]
    shapes = [SQUARE, [SQUARE[0][:-1], SQUARE[1][:-1]], [star], [], [[]], [[(0, 0), (8, 0), (8, 8)], [(-8, -8), (-1, -8), (-1, -1), (-8, -1)]]]
    shapes = [[[(float(x), float(y)) for x, y in r] for r in s] for s in shapes]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"i int, rings {G.RINGS}")
    places = [(a / 2, b / 2) for a in range(-18, 19) for b in range(-18, 19)]
    points = spark.createDataFrame(places, "x double, y double")
    got = {(r["i"], r["x"], r["y"]) for r in points.join(rows).where(geo.inside(F.col("x"), F.col("y"), F.col("rings"))).collect()}
    assert got == {(i, x, y) for i, s in enumerate(shapes) for x, y in places if plain_inside(x, y, s)}
    known = rows.where("size(rings) > 0 AND size(rings[0]) > 0")
    ends = [f(F.flatten("rings")[c]).alias(n) for n, f, c in (("west", F.array_min, "x"), ("south", F.array_min, "y"), ("east", F.array_max, "x"), ("north", F.array_max, "y"))]
    met = joins.polygon_join(points, known.select("*", *ends), ("y", "x"), 1.3)
    assert {(r["i"], r["x"], r["y"]) for r in met.collect()} == got and met.count() == len(got)
