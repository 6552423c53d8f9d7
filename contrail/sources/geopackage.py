"""Layers of GeoPackage files: attributes, and geometry as rings of coordinates, read within a box.

format("geopackage") gives a layer's own columns, fid, `kind`, `rings` (a point as a ring of one place, a line as one ring, a
polygon as its outer ring and its holes, collections as all of their parts) and the envelope `west`, `south`, `east`, `north`.
Bounds on the envelope reach the file: through its spatial index if it has one, and before a geometry is decoded.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator
from contextlib import closing

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .files import content, listed, located, put

RINGS = "array<array<struct<x:double,y:double>>>"
ENVELOPE = ("west", "south", "east", "north")
#: Fixed values of the format: doubles in a header's envelope by its code, kinds of geometry by number, columns by declared type.
ENVELOPES = {0: 0, 1: 4, 2: 6, 3: 6, 4: 8}
KINDS = {1: "point", 2: "linestring", 3: "polygon", 4: "multipoint", 5: "multilinestring", 6: "multipolygon", 7: "geometrycollection"}
TYPES = {"BOOLEAN": "boolean", "TINYINT": "long", "SMALLINT": "long", "MEDIUMINT": "long", "INT": "long", "INTEGER": "long", "FLOAT": "double", "DOUBLE": "double", "REAL": "double", "BLOB": "binary"}


def opened(address: str) -> sqlite3.Connection:
    """A SQLite file for reading only; one of a remote store is held in memory."""
    store, path = located(address)
    if isinstance(store, fs.LocalFileSystem):
        from urllib.parse import quote

        return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True, timeout=5.0)
    connection = sqlite3.connect(":memory:")
    connection.deserialize(content(address))
    return connection


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _wkb(raw: memoryview, at: int) -> tuple[str, list[np.ndarray], int]:
    """(kind, rings, end) of the geometry at a place; third and fourth coordinates are left out."""
    order = "<" if raw[at] else ">"
    code = struct.unpack_from(f"{order}I", raw, at + 1)[0]
    at += 5
    width = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    if code & 0x20000000:
        at += 4  # an identifier of the reference system
    code &= 0x1FFFFFFF
    width += (0, 1, 1, 2)[code // 1000]
    kind = KINDS.get(code % 1000)

    def count() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(f"{order}I", raw, at - 4)[0]

    def places(n: int) -> np.ndarray:
        nonlocal at
        at += 8 * width * n
        return np.frombuffer(raw, f"{order}f8", width * n, at - 8 * width * n).reshape(n, width)[:, :2]

    if kind == "point":
        here = places(1)
        return kind, [] if np.isnan(here).any() else [here], at
    if kind == "linestring":
        return kind, [places(count())], at
    if kind == "polygon":
        return kind, [places(count()) for _ in range(count())], at
    if kind is None:
        raise ValueError(f"no simple geometry: {code}")
    rings = []
    for _ in range(count()):
        _, own, at = _wkb(raw, at)
        rings += own
    return kind, rings, at


def envelope(blob: bytes) -> tuple[float, ...] | None:
    """(west, south, east, north) of a blob's header, None if it has none."""
    flags = blob[3]
    order, n = "<" if flags & 1 else ">", ENVELOPES[flags >> 1 & 7]
    if not n:
        return None
    west, east, south, north = struct.unpack_from(f"{order}4d", blob, 8)
    return west, south, east, north


def decoded(blob: bytes) -> tuple[str, list[np.ndarray]]:
    """(kind, rings) of a GeoPackage blob."""
    if blob[:2] != b"GP":
        raise ValueError("no GeoPackage geometry")
    kind, rings, _ = _wkb(memoryview(blob), 8 + 8 * ENVELOPES[blob[3] >> 1 & 7])
    return kind, [r for r in rings if len(r)]


def encoded(kind: str, rings: list[np.ndarray], srs: int = 4326) -> bytes:
    """A blob of a point, line or polygon, with its envelope."""
    places = np.concatenate(rings)
    (west, south), (east, north) = places.min(axis=0), places.max(axis=0)
    header = b"GP\0\x03" + struct.pack("<i4d", srs, west, east, south, north)
    code = next(k for k, v in KINDS.items() if v == kind)
    wkb = struct.pack("<BI", 1, code)
    if kind == "polygon":
        wkb += struct.pack("<I", len(rings))
    for ring in rings:
        wkb += b"" if kind == "point" else struct.pack("<I", len(ring))
        wkb += np.asarray(ring, "<f8").tobytes()
    return header + wkb


class GeoPackage(DataSource):
    """format("geopackage"): options path (a file or a folder of them) and layer; the first file gives the columns."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> str:
        path, layer = self.options["path"], self.options["layer"]
        files = listed(path, ".gpkg")
        if not files:
            raise FileNotFoundError(f"no GeoPackage in {path}")
        with closing(opened(_address(path, files[0]))) as db:
            shape = _geometry(db, layer)
            columns = db.execute(f"SELECT name, type, pk FROM pragma_table_info({layer!r})").fetchall()
        own = [f"`{n}` {TYPES.get(t.upper().split('(')[0], 'string')}" for n, t, pk in columns if n != shape and not pk]
        return ", ".join(["fid long", *own, "kind string", f"rings {RINGS}", *[f"{e} double" for e in ENVELOPE]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Layer(schema, self.options)


def _address(path: str, file: str) -> str:
    """The address of a file that was listed below `path`."""
    store, _ = located(path)
    return file if isinstance(store, fs.LocalFileSystem) else f"{path.split('://')[0]}://{file}"


def _geometry(db: sqlite3.Connection, layer: str) -> str:
    found = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE lower(table_name) = lower(?)", (layer,)).fetchone()
    if not found:
        raise ValueError(f"no layer {layer!r}")
    return found[0]


class _Layer(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.path, self.layer = options["path"], options["layer"]
        self.parts = int(options.get("numPartitions", "8"))
        self.own = [c for c in schema.fieldNames() if c not in ("fid", "kind", "rings", *ENVELOPE)]
        self.box = {e: [-np.inf, np.inf] for e in ENVELOPE}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute in [(e,) for e in ENVELOPE]:
                low, high = self.box[f.attribute[0]]
                below = isinstance(f, (LessThan, LessThanOrEqual))
                above = isinstance(f, (GreaterThan, GreaterThanOrEqual))
                self.box[f.attribute[0]] = [low if below else max(low, float(f.value)), high if above else min(high, float(f.value))]
            yield f  # rows outside are left out early; Spark has the last word

    def partitions(self) -> list[InputPartition]:
        out = []
        for file in listed(self.path, ".gpkg"):
            address = _address(self.path, file)
            with closing(opened(address)) as db:
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.layer)}").fetchone()
            if low is not None:
                step = max(1, -(-(high - low + 1) // self.parts))
                out += [InputPartition((address, i, min(high, i + step - 1))) for i in range(low, high + 1, step)]
        return out or [InputPartition(None)]

    def _outside(self, bounds: tuple[float, ...]) -> bool:
        return any(not low <= b <= high for b, (low, high) in zip(bounds, self.box.values(), strict=True))

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        address, low, high = partition.value
        bounded = any(np.isfinite(x) for b in self.box.values() for x in b)
        with closing(opened(address)) as db:
            shape = _geometry(db, self.layer)
            index = f"rtree_{self.layer}_{shape}"
            near, values = "", [low, high]
            if bounded and db.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (index,)).fetchone():
                # the index rounds outwards, so only its outer bounds may leave rows out
                near = f" AND rowid IN (SELECT id FROM {quoted(index)} WHERE minx <= ? AND miny <= ? AND maxx >= ? AND maxy >= ?)"
                values += [self.box["west"][1], self.box["south"][1], self.box["east"][0], self.box["north"][0]]
            own = "".join(f", {quoted(c)}" for c in self.own)
            for fid, blob, *rest in db.execute(f"SELECT rowid, {quoted(shape)}{own} FROM {quoted(self.layer)} WHERE rowid BETWEEN ? AND ?{near} ORDER BY rowid", values):
                bounds = envelope(blob) if blob else None
                if bounded and (not blob or bounds and self._outside(bounds)):
                    continue
                kind, rings = decoded(blob) if blob else (None, None)
                if rings and not bounds:
                    places = np.concatenate(rings)
                    bounds = (*places.min(axis=0).tolist(), *places.max(axis=0).tolist())
                points = [[(x, y) for x, y in r.tolist()] for r in rings] if rings is not None else None
                yield (fid, *rest, kind, points, *(bounds if rings else (None,) * 4))


def read_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """A layer of a GeoPackage file, or of a folder of them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GeoPackage)
    return spark.read.format("geopackage").options(path=path, layer=layer).load()


def within(rows: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """Rows whose envelope meets a box, edges included."""
    return rows.where((F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south))


def write_layer(rows: DataFrame, folder: str, layer: str, columns: list[str], file: str, indexed: bool = True) -> None:
    """Writes rows (`columns`, kind, rings) as GeoPackages, one for each value of `file`, whose rows one task holds."""

    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        with closing(sqlite3.connect(":memory:")) as db:
            db.execute("PRAGMA application_id = 1196444487")  # fixed value: GPKG
            db.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER)")
            db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT)")
            db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, 4326)", (layer, layer))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', 4326, 0, 0)", (layer,))
            kinds = {c: "INTEGER" if part[c].dtype.kind in "iu" else "DOUBLE" if part[c].dtype.kind == "f" else "TEXT" for c in columns}
            db.execute(f"CREATE TABLE {quoted(layer)} (fid INTEGER PRIMARY KEY, geom BLOB" + "".join(f", {quoted(c)} {k}" for c, k in kinds.items()) + ")")
            if indexed:
                db.execute(f"CREATE VIRTUAL TABLE {quoted(f'rtree_{layer}_geom')} USING rtree(id, minx, maxx, miny, maxy)")
            for i, row in enumerate(part.sort_values(columns).to_dict("records"), 1):
                rings = [np.array([(p["x"], p["y"]) for p in ring]) for ring in row["rings"]]
                blob = encoded(row["kind"], rings)
                db.execute(f"INSERT INTO {quoted(layer)} VALUES ({', '.join('?' * (2 + len(columns)))})", (i, blob, *(row[c] for c in columns)))
                if indexed:
                    west, south, east, north = envelope(blob)
                    db.execute(f"INSERT INTO {quoted(f'rtree_{layer}_geom')} VALUES (?, ?, ?, ?, ?)", (i, west, east, south, north))
            db.commit()
            put(folder, f"{layer}-{key[0]}.gpkg", db.serialize())
        return pd.DataFrame({"rows": [len(part)]})

    rows.groupBy(F.col(file).alias("_file")).applyInPandas(one, "rows long").write.format("noop").mode("overwrite").save()
