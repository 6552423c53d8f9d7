"""Grids in NetCDF files against arrays, and what of a file is read."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual

from contrail.sources import grids


def classic(version, lat, lon, values, scale=None, record=False, extra=False):
    """A small file written field by field: int16 values, CDF-1, -2 or -5, rows as records if asked."""
    n = "q" if version == 5 else "i"
    at = "i" if version == 1 else "q"
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    name = lambda s: struct.pack(f">{n}", len(s)) + pad(s.encode())
    none = struct.pack(f">i{n}", 0, 0)
    atts = none
    if scale:
        atts = struct.pack(f">i{n}", 12, 3) + name("scale_factor") + struct.pack(f">i{n}d", 6, 1, scale) + name("units") + struct.pack(f">i{n}", 2, 6) + pad(b"metres") + name("_FillValue") + struct.pack(f">i{n}", 3, 1) + pad(struct.pack(">h", -99))
    dims = struct.pack(f">i{n}", 10, 2) + name("latitude") + struct.pack(f">{n}", 0 if record else len(lat)) + name("lon") + struct.pack(f">{n}", len(lon))
    row = np.asarray(values, ">i2")
    var = [("lon", (1,), none, 5, np.asarray(lon, ">f4").tobytes())]
    if not record:
        var.append(("latitude", (0,), none, 6, np.asarray(lat, ">f8").tobytes()))
    var.append(("elevation", (0, 1), atts, 3, pad(row.tobytes())))

    def head(begins):
        out = b"CDF" + bytes([version]) + struct.pack(f">{n}", len(lat) if record else 0) + dims + none + struct.pack(f">i{n}", 11, len(var))
        for (v, d, a, kind, raw), b in zip(var, begins, strict=True):
            out += name(v) + struct.pack(f">{n}", len(d)) + b"".join(struct.pack(f">{n}", x) for x in d) + a + struct.pack(f">i{n}{at}", kind, len(raw), b)
        return out

    begins = [0] * len(var)
    begins = [len(head(begins)) + sum(len(v[4]) for v in var[:i]) for i in range(len(var))]
    return head(begins) + b"".join(v[4] for v in var)


LAT, LON = np.linspace(17, 19, 21), np.linspace(-68, -65, 31).astype(np.float32)
Z = np.random.default_rng(1).integers(-5000, 1000, (21, 31))


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("falling", [False, True])
def test_a_box_equals_the_array(spark, tmp_path, version, falling):
    lat, z = (LAT[::-1], Z[::-1].copy()) if falling else (LAT, Z.copy())
    z[4, 6] = -99
    (tmp_path / "a.nc").write_bytes(classic(version, lat, LON, z, scale=0.5))
    rows = grids.read_grid(spark, str(tmp_path / "a.nc"), slab=200)
    got = {(r["row"], r["col"]): (r["lat"], r["lon"], r["value"]) for r in rows.collect()}
    assert got == {(i, j): (lat[i], LON[j], None if z[i, j] == -99 else z[i, j] / 2) for i in range(21) for j in range(31)}
    box = grids.subset(spark, str(tmp_path / "a.nc"), 17.5, 18.2, -67.0, -66.5)
    want = {(i, j) for i in range(21) for j in range(31) if 17.5 <= lat[i] <= 18.2 and -67.0 <= LON[j] <= -66.5}
    assert {(r["row"], r["col"]) for r in box.collect()} == want and want


def test_only_the_slabs_of_the_box_are_planned(tmp_path):
    (tmp_path / "a.nc").write_bytes(classic(2, LAT, LON, Z))
    reader = grids._GridReader({"path": str(tmp_path), "slab": "124"})
    whole = reader.partitions()
    assert [p.value[3] for p in whole] == [(i, min(21, i + 2)) for i in range(0, 21, 2)]
    filters = [GreaterThanOrEqual(("lat",), 17.45), LessThan(("lat",), 18.0), GreaterThan(("lon",), -67.01), LessThanOrEqual(("lon",), -66.0), EqualTo(("row",), 3), GreaterThan(("value",), 2.0)]
    left = list(reader.pushFilters(filters))
    assert left == [filters[1], filters[2], filters[4], filters[5]]
    parts = reader.partitions()
    assert {p.value[4] for p in parts} == {(10, 21)} and parts[0].value[3][0] == 5 and parts[-1].value[3][1] == 11
    read = [b for p in parts for b in reader.read(p)]
    assert np.concatenate([b.column("value").to_numpy() for b in read]).tolist() == Z[5:11, 10:21].ravel().tolist()
    reader = grids._GridReader({"path": str(tmp_path)})
    list(reader.pushFilters([GreaterThan(("lat",), 50.0)]))
    assert [list(reader.read(p)) for p in reader.partitions()] == [[]]


def test_bounds_reach_the_files_from_sql(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(classic(2, LAT, LON, Z))
    rows = grids.read_grid(spark, str(tmp_path)).where("lat > 17.95 and lat < 18.15 and lon >= -66")
    assert rows.count() == 2 * 11


def test_records_and_errors(spark, tmp_path):
    raw = classic(1, LAT, LON, Z, record=True)
    (tmp_path / "r.nc").write_bytes(raw)
    with open(tmp_path / "r.nc", "rb") as f:
        head = grids.header(f)
    assert head.lengths == [21, 31] and head.variables["elevation"].step == 62
    with pytest.raises(ValueError, match="no axis"):
        grids.grid(grids.located(str(tmp_path))[0], str(tmp_path / "r.nc"), "elevation")
    (tmp_path / "a.nc").write_bytes(classic(2, LAT, LON, Z))
    with pytest.raises(ValueError, match="elevation"):
        grids.grid(grids.located(str(tmp_path))[0], str(tmp_path / "a.nc"), "z")
    (tmp_path / "x.nc").write_bytes(b"\x89HDF....")
    with pytest.raises(ValueError, match="classic"):
        grids.grid(grids.located(str(tmp_path))[0], str(tmp_path / "x.nc"), "z")
    with pytest.raises(ValueError, match="south < north"):
        grids.subset(spark, str(tmp_path / "a.nc"), 18, 17, -67, -66)
    with pytest.raises(ValueError, match="no cell"):
        grids.subset(spark, str(tmp_path / "a.nc"), 50, 51, -67, -66)
    assert grids.read_grid(spark, str(tmp_path / "none")).count() == 0


def test_what_is_written_is_read_back(spark, tmp_path):
    cells = spark.range(600).select((F.col("id") / 30).cast("long").alias("y"), (F.col("id") % 30 - 7).alias("x"), (F.col("id") * 1.5).alias("z")).where("id % 7 <> 0")
    grids.write_grid(cells, str(tmp_path / "g"), 0.25, rows=6)
    assert len(grids.listed(str(tmp_path / "g"))) == 4
    got = grids.read_grid(spark, str(tmp_path / "g"), slab=1000).where("value is not null")
    key = lambda r: (round(r["lat"] / 0.25 - 0.5), round(r["lon"] / 0.25 - 0.5), r["value"])
    assert sorted(map(key, got.collect())) == sorted((r["y"], r["x"], r["z"]) for r in cells.collect())
