"""Queries: entities over the tables, listed, filtered, fetched and patched, from Python and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.entities import Entities
from .mapping import AIR, OBS, airports, observations, table


def _entities(spark: SparkSession, sf_dir: str) -> Entities:
    e = Entities(spark)
    e.source("PRAirports", airports(spark, sf_dir), "airport_id")
    o = observations(spark, sf_dir).select("obs_id", "aircraft", "kind", F.when(F.col("k") % 5 > 0, F.col("k")).alias("k"), (F.col("obs_id") % 7).alias("rank"), (F.col("obs_id") % 2 == 0).alias("flag"), F.col("day").cast("string").alias("created_date"))
    e.source("AirspaceObservations", o, "obs_id")
    e.source("AircraftProfiles", table(spark, sf_dir, "customer").select(F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("tail"), F.col("c_mktsegment").alias("owner")), "tail")
    e.source("ManualReviewItems", table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")
    e.source("RouteSegments", table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    return e


def entity_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First pages by text, number, truth value and date, forwards and back; nothing, zero and false come as empty texts."""
    e = _entities(spark, sf_dir)
    pages = [("-created_date", 30), ("rank", 25), ("-k", 40), ("flag", 20), ("none", 5), ("-kind", -1)]
    out = None
    for sort, limit in pages:
        page = e.list("AirspaceObservations", sort, limit).select(F.lit(sort).alias("page"), "id", "created_date", "k")
        out = page if out is None else out.unionByName(page)
    return out


def entity_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered rows, with one added and one patched in the session."""
    e = _entities(spark, sf_dir)
    e.create("AircraftProfiles", {"id": "new", "owner": "BUILDING"})
    e.patch("AircraftProfiles", "N1", {"owner": "BUILDING"})
    own = e.filter("AircraftProfiles", {"owner": "BUILDING"}, "-tail", 10**6).select(F.lit("owner").alias("filter"), "id", "tail")
    none = e.filter("AirspaceObservations", {"k": None, "kind": "view"}, limit=10**6).select(F.lit("null").alias("filter"), "id", F.col("aircraft").alias("tail"))
    return own.unionByName(none)


def entity_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from SQL, by table functions."""
    _entities(spark, sf_dir).publish()
    by = "SELECT 'by' AS how, id, sort_text FROM (SELECT * FROM entity_AirspaceObservations_by('rank') ORDER BY sort_text DESC, obs_id LIMIT 60)"
    got = "SELECT 'get' AS how, id, airport AS sort_text FROM entity_PRAirports_get('7')"
    none = "SELECT 'none' AS how, id, '' AS sort_text FROM entity_FR24Captures_get('7')"
    return spark.sql(f"{by} UNION ALL {got} UNION ALL {none}")


def entity_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each of the seventeen entities has."""
    return _entities(spark, sf_dir).health()


QUERIES = {f.__name__: f for f in (entity_pages, entity_filters, entity_functions, entity_health)}

_E = "e AS (SELECT obs_id, CAST(obs_id AS VARCHAR) AS id, aircraft, kind, CASE WHEN k % 5 > 0 THEN k END AS k, obs_id % 7 AS rank, obs_id % 2 = 0 AS flag, CAST(day AS VARCHAR) AS created_date FROM obs)"
_COUNTS = {"PRAirports": "nation", "AirspaceObservations": "events", "AircraftProfiles": "customer", "ManualReviewItems": "labels", "RouteSegments": "orders"}
_EMPTY = ("ExportPackages", "ReadinessReports", "AnalysisLenses", "AnalysisObjectives", "LensCoverage", "RLSMSpatialObservations", "RLSMSpatialFrames", "RLSMZoomRungs", "FR24Captures", "InfrastructureAssets", "AirspaceAssetLinks", "FederationSyncEvents")
_PAGES = (("-created_date", "created_date DESC", 30), ("rank", "CASE WHEN rank = 0 THEN '' ELSE CAST(rank AS VARCHAR) END", 25), ("-k", "CASE WHEN coalesce(k, 0) = 0 THEN '' ELSE CAST(k AS VARCHAR) END DESC", 40), ("flag", "CASE WHEN flag THEN 'True' ELSE '' END", 20), ("none", "1", 5))
ORACLE = {
    "entity_pages": f"WITH {OBS}, {_E} " + " UNION ALL ".join(f"SELECT * FROM (SELECT '{p}' AS page, id, created_date, k FROM e ORDER BY {o}, obs_id LIMIT {n})" for p, o, n in _PAGES),
    "entity_filters": f"WITH {OBS}, {_E}, c AS (SELECT 'N' || c_custkey AS tail, CASE WHEN c_custkey = 1 THEN 'BUILDING' ELSE c_mktsegment END AS owner FROM customer) SELECT 'owner' AS filter, tail AS id, tail FROM c WHERE owner = 'BUILDING' UNION ALL SELECT 'owner', 'new', NULL UNION ALL SELECT 'null', id, aircraft FROM e WHERE k IS NULL AND kind = 'view'",
    "entity_functions": f"WITH {OBS}, {AIR}, {_E} SELECT * FROM (SELECT 'by' AS how, id, CASE WHEN rank = 0 THEN '' ELSE CAST(rank AS VARCHAR) END AS sort_text FROM e ORDER BY sort_text DESC, obs_id LIMIT 60) UNION ALL SELECT 'get', '7', airport FROM air WHERE airport_id = 7",
    "entity_health": " UNION ALL ".join([f"SELECT '{e}' AS entity, count(*) AS n FROM {t}" for e, t in _COUNTS.items()] + [f"SELECT '{e}', 0" for e in _EMPTY]),
}
