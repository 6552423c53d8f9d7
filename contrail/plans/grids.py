"""Queries: grids and layers of geometry, written to files and read back within a box, and what lies in a polygon."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import terrain as T
from ..operators import joins as J
from ..operators import tiles
from ..operators.cuts import cut, shared_folder
from ..sources import geopackage as G
from ..sources import grids
from .mapping import AIR, OBS, airports, observations, table
from .records import _dem

#: A box for reading: south, north, west, east.
BOX = (18.0, 18.41, -66.9, -66.0)


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/grids-{uuid.uuid4()}"


def netcdf_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of heights written as NetCDF files of four rows each, and the cells of a box read back."""
    at = _folder(spark)
    grids.write_grid(_dem(spark, sf_dir), at, 0.05, rows=4)
    cells = grids.subset(spark, at, *BOX).where("value IS NOT NULL")
    y, x = (F.round(F.col(c) / 0.05 - 0.5).cast("long") for c in ("lat", "lon"))
    return cells.select(y.alias("y"), x.alias("x"), F.round("value", 9).alias("z"))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Around each airport a square on its corner, less a smaller one."""
    x, y = F.col("a_lon"), F.col("a_lat")

    def ring(r: float):
        corners = [(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)]
        return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in corners])

    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("airport_id"), "n_regionkey")
    a = airports(spark, sf_dir).join(n, "airport_id")
    wide = F.col("airport_id") % 3 == 0
    return a.select("airport_id", "airport", F.col("n_regionkey").alias("file"), F.lit("polygon").alias("kind"), F.when(wide, F.array(ring(0.2), ring(0.1))).otherwise(F.array(ring(0.2))).alias("rings"))


def geopackage_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of five GeoPackages with a spatial index, and points of one without, whose envelopes meet a box."""
    at = _folder(spark)
    G.write_layer(_zones(spark, sf_dir), f"{at}/zones", "zones", ["airport_id", "airport"], "file")
    place = F.struct(F.col("a_lon").alias("x"), F.col("a_lat").alias("y"))
    middles = airports(spark, sf_dir).select("airport_id", "airport", F.lit(0).alias("file"), F.lit("point").alias("kind"), F.array(F.array(place)).alias("rings"))
    G.write_layer(middles, f"{at}/middles", "middles", ["airport_id", "airport"], "file", indexed=False)
    south, north, west, east = BOX
    both = [G.within(G.read_layer(spark, f"{at}/{n}", n), south, west, north, east) for n in ("zones", "middles")]
    return both[0].unionByName(both[1]).select("airport_id", "airport", "kind", F.size("rings").alias("n_rings"), *[F.round(e, 6).alias(e) for e in G.ENVELOPE])


def zone_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings in each zone of a layer read from files, holes left out, edges counted."""
    at = _folder(spark)
    G.write_layer(_zones(spark, sf_dir), at, "zones", ["airport_id", "airport"], "file")
    zones = cut(G.read_layer(spark, at, "zones"))
    # sightings at one position lie in the same zones
    places = observations(spark, sf_dir).groupBy("lat", "lon").agg(F.count("*").alias("n"), F.min("obs_id").alias("first_obs"))
    met = J.polygon_join(places, zones, ("lat", "lon"), 0.1)
    return met.groupBy("airport_id").agg(F.sum("n").alias("n"), F.min("first_obs").alias("first_obs"))


def _depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights from far below the sea to just above it."""
    return _dem(spark, sf_dir).select("y", "x", (F.col("z") * F.lit(0.05) - 350.0).alias("z"))


#: Metres of a cell of 0.05 degrees at 18.3 degrees north.
_DX, _DY = 0.05 * 111_320.0 * 0.9494188414, 0.05 * 111_320.0


def terrain_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope, curvatures, roughness and rugosity of every cell, over tiles of eight by eight cells."""

    def measure(grid, gaps):
        slope, east, north = T.slopes(grid, _DX, _DY)
        profile, plan, general = T.curvatures(grid, _DX, _DY)
        return {
            "slope_deg": slope, "dz_dx": east, "dz_dy": north, "profile": profile, "plan": plan, "general": general,
            "roughness": T.roughness(grid, 3, gaps), "area_ratio": T.area_ratio(grid, _DX, _DY), "vrm": T.ruggedness(grid, _DX, _DY),
        }

    names = ["slope_deg", "dz_dx", "dz_dy", "profile", "plan", "general", "roughness", "area_ratio", "vrm"]
    made = tiles.by_tiles(_depths(spark, sf_dir), measure, names, rim=3, size=8)
    return made.select("y", "x", *[F.round(n, 9).alias(n) for n in names])


def underwater_ridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells under water, two hundred metres deep at most, that are higher than all four neighbours."""
    d = _depths(spark, sf_dir)
    made = tiles.by_tiles(d, lambda grid, gaps: {"ridge": T.ridges(grid)}, ["ridge"], size=8)
    return made.where("ridge = 1").join(d, ["y", "x"]).select("y", "x", F.round("z", 9).alias("z"))


def passage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, least and greatest depth of each row of cells across a passage."""
    d = _depths(spark, sf_dir).where(F.col("x").between(-1346, -1330))
    return tiles.row_profile(d).select("y", *[F.round(c, 9).alias(c) for c in ("mean_z", "min_z", "max_z")])


def line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths at two hundred places on a line through the grid."""
    met = tiles.along(_depths(spark, sf_dir), (17.93, -67.28), (18.71, -65.17), 200, 0.05)
    return met.select("sample", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), F.round("z", 9).alias("z"))


QUERIES = {f.__name__: f for f in (netcdf_subset, geopackage_layer, zone_containment, terrain_measures, underwater_ridges, passage_profile, line_profile)}

_DEPTHS = "g AS (SELECT CAST(floor(lat / CAST(0.05 AS DOUBLE)) AS BIGINT) AS y, CAST(floor(lon / CAST(0.05 AS DOUBLE)) AS BIGINT) AS x, avg(altitude_ft) * CAST(0.05 AS DOUBLE) - 350 AS z FROM obs GROUP BY 1, 2)"
_IN_BOX = "south <= 18.41 AND north >= 18.0 AND west <= -66.0 AND east >= -66.9"
ORACLE = {
    "netcdf_subset": f"WITH {OBS}, g AS (SELECT CAST(floor(lat / CAST(0.05 AS DOUBLE)) AS BIGINT) AS y, CAST(floor(lon / CAST(0.05 AS DOUBLE)) AS BIGINT) AS x, avg(altitude_ft) AS z FROM obs GROUP BY 1, 2) SELECT y, x, round(z, 9) AS z FROM g WHERE (y + 0.5) * 0.05 BETWEEN 18.0 AND 18.41 AND (x + 0.5) * 0.05 BETWEEN -66.9 AND -66.0",
    "geopackage_layer": f"""WITH {AIR}, r AS (SELECT airport_id, airport, 'polygon' AS kind, CASE WHEN airport_id % 3 = 0 THEN 2 ELSE 1 END AS n_rings, a_lon - CAST(0.2 AS DOUBLE) AS west, a_lat - CAST(0.2 AS DOUBLE) AS south, a_lon + CAST(0.2 AS DOUBLE) AS east, a_lat + CAST(0.2 AS DOUBLE) AS north FROM air
 UNION ALL SELECT airport_id, airport, 'point', 1, a_lon, a_lat, a_lon, a_lat FROM air) SELECT airport_id, airport, kind, n_rings, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north FROM r WHERE {_IN_BOX}""",
    "zone_containment": f"""WITH {OBS}, {AIR}, m AS (SELECT airport_id, obs_id, abs(lon - a_lon) + abs(lat - a_lat) AS d FROM obs, air)
 SELECT airport_id, count(*) AS n, min(obs_id) AS first_obs FROM m WHERE d <= 0.2 AND (airport_id % 3 <> 0 OR d >= 0.1) GROUP BY 1""",
    "underwater_ridges": f"""WITH {OBS}, {_DEPTHS} SELECT g.y, g.x, round(g.z, 9) AS z FROM g JOIN g n ON abs(n.y - g.y) + abs(n.x - g.x) = 1
 WHERE g.z < 0 AND g.z >= -200 GROUP BY g.y, g.x, g.z HAVING count(*) = 4 AND bool_and(g.z > n.z)""",
    "passage_profile": f"WITH {OBS}, {_DEPTHS} SELECT y, round(avg(z), 9) AS mean_z, round(min(z), 9) AS min_z, round(max(z), 9) AS max_z FROM g WHERE x BETWEEN -1346 AND -1330 GROUP BY y",
    "line_profile": f"""WITH {OBS}, {_DEPTHS}, l AS (SELECT i AS sample, 17.93::DOUBLE + i / 199.0::DOUBLE * (18.71::DOUBLE - 17.93::DOUBLE) AS lat, -67.28::DOUBLE + i / 199.0::DOUBLE * (-65.17::DOUBLE - -67.28::DOUBLE) AS lon FROM range(200) r(i))
 SELECT sample, round(lat, 6) AS lat, round(lon, 6) AS lon, round(z, 9) AS z FROM l LEFT JOIN g ON g.y = floor(lat / CAST(0.05 AS DOUBLE)) AND g.x = floor(lon / CAST(0.05 AS DOUBLE))""",
}
