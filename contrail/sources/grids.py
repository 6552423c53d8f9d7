"""Grids in classic NetCDF files (CDF-1, -2 and -5), read by slabs of rows and written by bands.

format("netcdf_grid") gives rows (row, col, lat, lon, value) of one variable over latitude and longitude. Only a file's header
and its two axes are read to plan; slabs are ranges of bytes from the header's offsets. Bounds on lat and lon cut the slabs to
the rows and columns of their box, so nothing else of the file is read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .files import listed, located, put

#: Fixed values of the format: tags of the header's lists, and the types by number.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
SCHEMA = "row long, col long, lat double, lon double, value double"
#: Bytes of a slab.
SLAB = 4 << 20
#: Names that an axis goes by.
AXES = (("lat", "latitude", "y"), ("lon", "longitude", "x"))


class Variable(NamedTuple):
    """A variable of a file: its dimensions, type, attributes, where it begins and how far apart its records are."""

    dims: tuple[int, ...]
    kind: np.dtype
    attributes: dict
    begin: int
    step: int


class Header(NamedTuple):
    """Lengths of the dimensions by number, and variables by name."""

    lengths: list[int]
    variables: dict[str, Variable]


def header(file) -> Header:
    """The header of an open file."""
    version = file.read(4)
    if version[:3] != b"CDF" or version[3] not in (1, 2, 5):
        raise ValueError("no classic NetCDF file")
    wide = version[3] == 5

    def number(code: str) -> int:
        return struct.unpack(f">{code}", file.read(struct.calcsize(code)))[0]

    count = lambda: number("q" if wide else "i")

    def padded(n: int) -> bytes:
        return file.read(n + -n % 4)[:n]

    def entries(tag: int) -> range:
        found, n = number("i"), count()
        if found not in (0, tag):
            raise ValueError("a broken NetCDF header")
        return range(n)

    def attributes() -> dict:
        out = {}
        for _ in entries(ATTRIBUTES):
            name = padded(count()).decode()
            kind = np.dtype(TYPES[number("i")])
            n = count()
            raw = padded(n * kind.itemsize)
            out[name] = raw.decode() if kind.kind == "S" else np.frombuffer(raw, kind).tolist()
        return out

    records = count()
    lengths, record = [], None
    for i in entries(DIMENSIONS):
        padded(count())
        lengths.append(count())
        if lengths[-1] == 0:
            record, lengths[-1] = i, max(records, 0)
    attributes()
    raw = []
    for _ in entries(VARIABLES):
        name = padded(count()).decode()
        dims = tuple(count() for _ in range(count()))
        own, kind, size = attributes(), np.dtype(TYPES[number("i")]), count()
        raw.append((name, dims, kind, own, size, number("i" if version[3] == 1 else "q")))
    moving = [r for r in raw if r[1] and r[1][0] == record]
    # one record holds a row of each variable that has them; a single one is not padded
    step = int(np.prod([lengths[d] for d in moving[0][1][1:]], dtype=np.int64)) * moving[0][2].itemsize if len(moving) == 1 else sum(r[4] for r in moving)
    return Header(lengths, {n: Variable(d, k, a, at, step if d and d[0] == record else 0) for n, d, k, a, _, at in raw})


class Grid(NamedTuple):
    """Where a file's variable lies, and its axes."""

    path: str
    variable: Variable
    lat: np.ndarray
    lon: np.ndarray


def _axis(file, head: Header, dim: int, names: tuple[str, ...]) -> np.ndarray:
    for name in names:
        v = head.variables.get(name)
        if v and v.dims == (dim,):
            if v.step:
                raise ValueError(f"the axis {name} has no fixed length")
            file.seek(v.begin)
            return np.frombuffer(file.read(head.lengths[dim] * v.kind.itemsize), v.kind).astype(float)
    raise ValueError(f"no axis named {' or '.join(names)}")


def grid(store: fs.FileSystem, path: str, name: str) -> Grid:
    """A file's grid by the name of its variable."""
    with store.open_input_file(path) as file:
        head = header(file)
        v = head.variables.get(name)
        if not v or len(v.dims) != 2:
            raise ValueError(f"no variable {name!r} over two dimensions in {path}; there are {', '.join(sorted(head.variables))}")
        return Grid(path, v, *(_axis(file, head, d, n) for d, n in zip(v.dims, AXES, strict=True)))


def _range(axis: np.ndarray, low: float, high: float) -> tuple[int, int]:
    """First place, and that past the last, of an axis's values within bounds; the axis rises or falls."""
    inside = np.flatnonzero((axis >= low) & (axis <= high))
    return (int(inside[0]), int(inside[-1]) + 1) if len(inside) else (0, 0)


class NetcdfGrid(DataSource):
    """format("netcdf_grid"): options path (a file or a folder), variable (elevation) and slab (bytes of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "netcdf_grid"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _GridReader(self.options)


class _GridReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.variable = options["path"], options.get("variable", "elevation")
        self.slab = int(options.get("slab", SLAB))
        self.box = {"lat": [-np.inf, np.inf], "lon": [-np.inf, np.inf]}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in self.box and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                value = float(f.value)
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.box[name][0] = max(self.box[name][0], value)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.box[name][1] = min(self.box[name][1], value)
            if name not in self.box or not isinstance(f, (EqualTo, GreaterThanOrEqual, LessThanOrEqual)):
                yield f  # what a closed box does not say is left to Spark

    def partitions(self) -> list[InputPartition]:
        store, _ = located(self.path)
        parts = []
        for path in listed(self.path):
            g = grid(store, path, self.variable)
            top, bottom = _range(g.lat, *self.box["lat"])
            left, right = _range(g.lon, *self.box["lon"])
            if left == right:
                continue
            step = max(1, self.slab // ((right - left) * g.variable.kind.itemsize))
            for row in range(top, bottom, step):
                rows = (row, min(bottom, row + step))
                parts.append(InputPartition((path, tuple(g.variable), len(g.lon), rows, (left, right), g.lat[slice(*rows)].tobytes(), g.lon[left:right].tobytes())))
        return parts or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, variable, width, rows, columns, lat, lon = partition.value
        v = Variable(*variable)
        lat, lon = np.frombuffer(lat), np.frombuffer(lon)
        step, (left, right) = v.step or width * v.kind.itemsize, columns
        pieces = []
        with located(self.path)[0].open_input_file(path) as file:
            if v.step or right - left < width:
                for row in range(*rows):
                    file.seek(v.begin + row * step + left * v.kind.itemsize)
                    pieces.append(file.read((right - left) * v.kind.itemsize))
            else:
                file.seek(v.begin + rows[0] * step)
                pieces.append(file.read((rows[1] - rows[0]) * step))
        raw = np.frombuffer(b"".join(pieces), v.kind).reshape(len(lat), len(lon))
        absent = np.isnan(raw) if v.kind.kind == "f" else np.zeros(raw.shape, bool)
        for mark in ("_FillValue", "missing_value"):
            for value in v.attributes.get(mark, ()):
                absent |= raw == value
        value = raw * v.attributes.get("scale_factor", [1.0])[0] + v.attributes.get("add_offset", [0.0])[0] if {"scale_factor", "add_offset"} & set(v.attributes) else raw
        many = max(1, 50_000 // len(lon))
        for i in range(0, len(lat), many):
            n = len(lat[i : i + many])
            arrays = [
                pa.array(np.repeat(np.arange(rows[0] + i, rows[0] + i + n), len(lon))),
                pa.array(np.tile(np.arange(left, right), n)),
                pa.array(np.repeat(lat[i : i + n], len(lon))),
                pa.array(np.tile(lon, n)),
                pa.array(value[i : i + n].astype(float).ravel(), mask=absent[i : i + n].ravel()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "col", "lat", "lon", "value"])


def read_grid(spark: SparkSession, path: str, variable: str = "elevation", slab: int = SLAB) -> DataFrame:
    """Rows (row, col, lat, lon, value) of a grid; filters on lat and lon reach the files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetcdfGrid)
    return spark.read.format("netcdf_grid").options(path=path, variable=variable, slab=str(slab)).load()


def subset(spark: SparkSession, path: str, south: float, north: float, west: float, east: float, variable: str = "elevation") -> DataFrame:
    """The cells of a box, edges included; an error for a box turned round, or one without a cell."""
    if south >= north or west >= east:
        raise ValueError(f"a box needs south < north and west < east, not {south}, {north}, {west}, {east}")
    rows = read_grid(spark, path, variable).where(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    if rows.isEmpty():
        raise ValueError(f"no cell in {south}, {north}, {west}, {east}")
    return rows


def encoded(lat: np.ndarray, lon: np.ndarray, values: np.ndarray, variable: str, fill: float) -> bytes:
    """A CDF-2 file of a variable of doubles over two axes."""
    name = lambda s: struct.pack(">i", len(s)) + s.encode().ljust(len(s) + -len(s) % 4, b"\0")
    dims = struct.pack(">ii", DIMENSIONS, 2) + name("lat") + struct.pack(">i", len(lat)) + name("lon") + struct.pack(">i", len(lon))
    none = struct.pack(">ii", 0, 0)
    filled = struct.pack(">ii", ATTRIBUTES, 1) + name("_FillValue") + struct.pack(">iid", 6, 1, fill)
    parts = [("lat", (0,), none, lat), ("lon", (1,), none, lon), (variable, (0, 1), filled, np.where(np.isnan(values), fill, values))]

    def head(begins: list[int]) -> bytes:
        variables = b"".join(
            name(n) + struct.pack(f">i{len(d)}i", len(d), *d) + own + struct.pack(">iiq", 6, a.size * 8, at) for (n, d, own, a), at in zip(parts, begins, strict=True)
        )
        return b"CDF\x02" + struct.pack(">i", 0) + dims + none + struct.pack(">ii", VARIABLES, len(parts)) + variables

    sizes = [a.size * 8 for *_, a in parts]
    first = len(head([0, 0, 0]))
    begins = [first + sum(sizes[:i]) for i in range(3)]
    return head(begins) + b"".join(np.asarray(a, ">f8").tobytes() for *_, a in parts)


def write_grid(cells: DataFrame, folder: str, size: float, rows: int = 256, variable: str = "elevation", fill: float = -32768.0) -> None:
    """Writes cells (y, x, z), y and x whole numbers of cells of `size` degrees, as NetCDF files of `rows` rows each; the axes are
    the cells' middles. A file's task holds its band of rows, over all columns."""
    ends = cells.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    if ends["low"] is None:
        return
    x = np.arange(ends["low"], ends["high"] + 1)

    def band(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        y = np.arange(part["y"].min(), part["y"].max() + 1)
        values = np.full((len(y), len(x)), np.nan)
        values[part["y"] - y[0], part["x"] - x[0]] = part["z"]
        put(folder, f"band{key[0]}.nc", encoded((y + 0.5) * size, (x + 0.5) * size, values, variable, fill))
        return pd.DataFrame({"rows": [len(part)]})

    cells.select("y", "x", "z").groupBy(F.floor(F.col("y") / rows).alias("band")).applyInPandas(band, "rows long").write.format("noop").mode("overwrite").save()
