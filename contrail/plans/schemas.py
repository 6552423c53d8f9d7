"""Schemas of records, as documents, and the queries that hold records against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schemas as S
from .mapping import OBS, observations

# The members, constants and limits that records of the three streams must keep.
OBSERVATION = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "type": "object",
    "required": ["id", "score", "status"],
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "score": {"type": "number", "minimum": 0, "maximum": 1},
        "status": {"enum": ["ok", "held"]},
        "note": {"type": ["string", "null"], "minLength": 1},
        "place": {"$ref": "#/definitions/place"},
        "tags": {"type": "array", "items": {"type": "string", "pattern": "^[a-z]+$"}, "uniqueItems": True},
    },
    "definitions": {
        "place": {
            "type": "object",
            "required": ["lat", "lon"],
            "additionalProperties": False,
            "properties": {"lat": {"type": "number", "minimum": -90, "maximum": 90}, "lon": {"type": "number", "minimum": -180, "maximum": 180}},
        }
    },
}
SESSION = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "type": "object",
    "additionalProperties": False,
    "required": ["replay_id", "timeline_policy", "interpolation", "source_ids"],
    "properties": {
        "replay_id": {"type": "string", "minLength": 1},
        "timeline_policy": {"const": "union_observation_timestamps"},
        "interpolation": {"const": "none"},
        "source_ids": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"type": "string", "minLength": 1}},
        "start_utc": {"type": "string", "format": "date-time"},
        "end_utc": {"type": "string", "format": "date-time"},
    },
}
#: Labels that no record may carry as a value.
PROHIBITED = ["confirmed", "accepted"]

_BODY = """concat('{"id": ', CASE obs_id % 5 WHEN 0 THEN '"5"' WHEN 1 THEN '5.5' WHEN 2 THEN '0' WHEN 3 THEN '7.0' ELSE CAST(obs_id + 1 AS STRING) END,
 ', "score": ', CASE k % 4 WHEN 0 THEN '1.5' WHEN 1 THEN 'null' ELSE '0.25' END, CASE WHEN obs_id % 7 = 0 THEN '' WHEN obs_id % 7 = 1 THEN ', "status": "Held"' ELSE ', "status": "ok"' END,
 CASE obs_id % 6 WHEN 0 THEN ', "note": ""' WHEN 1 THEN ', "note": null' WHEN 2 THEN ', "note": " Confirmed "' ELSE '' END,
 CASE k % 5 WHEN 0 THEN ', "place": {"lat": 18.5}' WHEN 1 THEN ', "place": {"lat": 118.5, "lon": -66, "x": 1}' WHEN 2 THEN ', "place": [18, -66]' ELSE ', "place": {"lat": 18.5, "lon": -66}' END,
 CASE k % 3 WHEN 0 THEN ', "tags": ["a", "B", "a"]' WHEN 1 THEN ', "tags": []' ELSE '' END, CASE WHEN obs_id % 13 = 0 THEN '' ELSE '}' END)"""
_SESSION = """concat('{"replay_id": "', CASE WHEN obs_id % 5 > 0 THEN CAST(obs_id AS STRING) ELSE '' END, '", "timeline_policy": "', CASE WHEN k % 2 = 0 THEN 'union_observation_timestamps' ELSE 'grid' END, '"',
 CASE WHEN obs_id % 3 > 0 THEN ', "interpolation": "none"' ELSE '' END, ', "source_ids": ', CASE k % 4 WHEN 0 THEN '[]' WHEN 1 THEN '["a", "a", 3]' WHEN 2 THEN '"a"' ELSE '["a", "b"]' END,
 CASE obs_id % 4 WHEN 0 THEN ', "start_utc": "2024-01-08T14:35:00Z"' WHEN 1 THEN ', "start_utc": "2024-13-08T14:35:00Z"' WHEN 2 THEN ', "start_utc": "2024-01-08"' ELSE ', "clock": 1' END, '}')"""


def schema_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records against a schema with nested members, references and arrays: what is wrong, valid ones apart from rejects."""
    r = observations(spark, sf_dir).selectExpr("obs_id", f"{_BODY} AS body")
    found = S.validated(r, "body", OBSERVATION, PROHIBITED)
    return found.select("obs_id", F.array_join("errors", "; ").alias("errors"), F.when(F.size("errors") == 0, "valid").otherwise("reject").alias("split"))


def session_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay sessions against their schema, which allows no other members."""
    r = observations(spark, sf_dir).selectExpr("obs_id", f"{_SESSION} AS body")
    found = S.validated(r, "body", SESSION)
    return found.select("obs_id", F.array_join("errors", "; ").alias("errors"), F.when(F.size("errors") == 0, "valid").otherwise("reject").alias("split"))


QUERIES = {f.__name__: f for f in (schema_validation, session_validation)}

_SPLIT = "SELECT obs_id, array_to_string(list_filter(e, lambda x: x IS NOT NULL), '; ') AS errors, CASE WHEN len(list_filter(e, lambda x: x IS NOT NULL)) = 0 THEN 'valid' ELSE 'reject' END AS split FROM e"
_NUMBER = "('BIGINT', 'UBIGINT', 'DOUBLE')"
ORACLE = {
    "schema_validation": f"""WITH {OBS}, t AS (SELECT obs_id, {_BODY.replace('AS STRING', 'AS VARCHAR')} AS b FROM obs), p AS (SELECT obs_id, json_valid(b) AS ok, CASE WHEN json_valid(b) THEN b ELSE '{{}}' END AS b FROM t),
 j AS (SELECT *, json_type(b, '$.id') AS ti, CAST(b ->> '$.id' AS VARCHAR) AS i, json_type(b, '$.score') AS ts, b ->> '$.score' AS s, b ->> '$.status' AS st, json_type(b, '$.note') AS tn, b ->> '$.note' AS n, json_type(b, '$.place') AS tp, b ->> '$.place.lat' AS la, b ->> '$.place.lon' AS lo, b ->> '$.place.x' AS px, CAST(b -> '$.tags' AS VARCHAR[]) AS tags FROM p),
 e AS (SELECT obs_id, CASE WHEN NOT ok THEN ['$: not JSON'] ELSE list_concat([
 CASE WHEN st IS NULL THEN '$.status: required' END,
 CASE WHEN ti NOT IN {_NUMBER} OR TRY_CAST(i AS DOUBLE) <> floor(TRY_CAST(i AS DOUBLE)) THEN '$.id: type' END, CASE WHEN ti IN {_NUMBER} AND TRY_CAST(i AS DOUBLE) < 1 THEN '$.id: minimum' END,
 CASE WHEN ts NOT IN {_NUMBER} THEN '$.score: type' END, CASE WHEN ts IN {_NUMBER} AND TRY_CAST(s AS DOUBLE) > 1 THEN '$.score: maximum' END,
 CASE WHEN st NOT IN ('ok', 'held') THEN '$.status: enum' END, CASE WHEN tn = 'VARCHAR' AND n = '' THEN '$.note: minLength' END,
 CASE WHEN tp <> 'OBJECT' THEN '$.place: type' END, CASE WHEN tp = 'OBJECT' AND lo IS NULL THEN '$.place.lon: required' END,
 CASE WHEN TRY_CAST(la AS DOUBLE) > 90 THEN '$.place.lat: maximum' END, CASE WHEN px IS NOT NULL THEN '$.place.x: additionalProperties' END,
 CASE WHEN len(list_distinct(tags)) < len(tags) THEN '$.tags: uniqueItems' END],
 list_transform(range(len(coalesce(tags, []))), lambda x: CASE WHEN NOT regexp_matches(tags[x + 1], '^[a-z]+$') THEN '$.tags[' || x || ']: pattern' END),
 [CASE WHEN lower(trim(n)) IN ('confirmed', 'accepted') THEN '$: prohibited label' END]) END AS e FROM j) {_SPLIT}""",
    "session_validation": f"""WITH {OBS}, t AS (SELECT obs_id, {_SESSION.replace('AS STRING', 'AS VARCHAR')} AS b FROM obs),
 j AS (SELECT *, json_type(b, '$.source_ids') AS ts, CASE WHEN json_type(b, '$.source_ids') = 'ARRAY' THEN CAST(b -> '$.source_ids' AS VARCHAR[]) END AS s, b ->> '$.start_utc' AS u FROM t),
 e AS (SELECT obs_id, list_concat([CASE WHEN json_type(b, '$.interpolation') IS NULL THEN '$.interpolation: required' END, CASE WHEN b ->> '$.replay_id' = '' THEN '$.replay_id: minLength' END,
 CASE WHEN b ->> '$.timeline_policy' <> 'union_observation_timestamps' THEN '$.timeline_policy: const' END, CASE WHEN ts <> 'ARRAY' THEN '$.source_ids: type' END,
 CASE WHEN len(s) < 1 THEN '$.source_ids: minItems' END, CASE WHEN len(list_distinct(s)) < len(s) THEN '$.source_ids: uniqueItems' END],
 list_transform(range(len(coalesce(s, []))), lambda x: CASE WHEN json_type(b, '$.source_ids[' || x || ']') <> 'VARCHAR' THEN '$.source_ids[' || x || ']: type' END),
 [CASE WHEN u IS NOT NULL AND (NOT regexp_full_match(u, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}Z') OR TRY_CAST(u AS TIMESTAMP) IS NULL) THEN '$.start_utc: format' END, CASE WHEN json_type(b, '$.clock') IS NOT NULL THEN '$.clock: additionalProperties' END]) AS e FROM j) {_SPLIT}""",
}
