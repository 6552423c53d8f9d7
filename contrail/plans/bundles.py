"""Queries: replay bundles written, read back, checked and sealed."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cuts import shared_folder
from ..sources import bundles as B
from ..sources.files import put
from .mapping import OBS, observations, table

_SENSORS = {"view": "aircraft_observation", "click": "provider_rendered_frame", "purchase": "weather_timeseries"}


def _written(spark: SparkSession, sf_dir: str, faults: bool) -> str:
    """A bundle of all views, clicks and purchases; with faults, members that are missing, replaced or not below the folder, and
    observations that break one rule each."""
    folder = f"{shared_folder(spark)}/bundle-{uuid.uuid4()}"
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("key"), F.concat(F.lit("frame of "), "n_name").alias("text"))

    def frames(part: pd.DataFrame) -> pd.DataFrame:
        for key, text in zip(part["key"], part["text"], strict=True):
            if not (faults and key == 3):
                put(f"{folder}/frames", f"f{key}.txt", (text + "!" * (faults and key == 4)).encode())
        return part[["key"]]

    n.groupBy("key").applyInPandas(frames, "key int").write.format("noop").mode("overwrite").save()
    path = F.concat(F.lit("frames/f"), F.col("key").cast("string"), F.lit(".txt"))
    if faults:
        path = F.when(F.col("key") == 5, "../outside.txt").otherwise(path)
    members = n.agg(F.collect_list(F.struct(path.alias("path"), F.sha2("text", 256).alias("sha256"))).alias("members"))
    sources = F.array(*[F.struct(F.lit(f"s-{k}").alias("source_id"), F.lit(s).alias("sensor_type")) for k, s in _SENSORS.items()])
    spans = [("s-view", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00+04:00"), ("s-view", "2024-01-02T12:00:00Z" if faults else "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z"), ("s-click", "2024-01-02T00:00:00Z", "2024-01-02T01:00:00Z")]
    gaps = F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(("source_id", "start_utc", "end_utc"), s, strict=True)]) for s in spans])
    head = members.select(F.lit(B.PROTOCOL).alias("protocol"), F.lit("all").alias("replay_id"), sources.alias("sources"), "members", gaps.alias("gaps"), F.lit("observations").alias("observations"))
    head.select(F.to_json(F.struct(*head.columns)).alias("value")).write.text(f"{folder}/manifest.json")

    o = observations(spark, sf_dir).where(F.col("kind").isin(*_SENSORS)).join(n, F.col("obs_id") % 25 == F.col("key"))
    payload = F.struct(
        F.when(F.col("kind") == "view", F.col("lat")).alias("lat"), F.when(F.col("kind") == "view", F.col("lon")).alias("lon"),
        F.when(F.col("kind") == "click", path).alias("member_path"), F.when(F.col("kind") == "click", F.sha2("text", 256)).alias("content_sha256"), F.when(F.col("kind") == "click", F.lit(B.FRAME)).alias("product_type"),
        F.when(F.col("kind") == "purchase", F.lit("wind")).alias("parameter"), F.when(F.col("kind") == "purchase", F.col("value")).alias("value"), F.when(F.col("kind") == "purchase", F.lit("kt")).alias("unit"),
    )
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.lit("Z")
    source = F.concat(F.lit("s-"), "kind")
    if faults:
        zone = F.when(F.col("obs_id") % 11 == 0, "").otherwise("Z")
        source = F.when(F.col("obs_id") % 13 == 0, "s-none").when(F.col("obs_id") % 17 == 0, "s-view").otherwise(source)
    sensor = F.element_at(F.create_map(*[F.lit(x) for kv in _SENSORS.items() for x in kv]), F.col("kind"))
    row = F.struct(F.concat(F.lit("o"), F.col("obs_id").cast("string")).alias("observation_id"), source.alias("source_id"), sensor.alias("sensor_type"), F.concat(at, zone).alias("event_time_utc"), payload.alias("payload"))
    o.select(F.to_json(row).alias("value")).write.text(f"{folder}/observations")
    return folder


def replay_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The receipt of a sound bundle; its digest is there and has 64 digits."""
    got = B.receipt(B.read(spark, _written(spark, sf_dir, False)))
    row = {k: got[k] for k in ("replay_id", "source_count", "member_count", "observation_count", "timestamp_count")} | {"sealed": len(got["content_digest"]) == 64}
    return spark.createDataFrame([tuple(row.values())], "replay_id string, source_count long, member_count long, observation_count long, timestamp_count long, sealed boolean")


def replay_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps a faulty bundle from being sealed, by rule."""
    return B.findings(B.read(spark, _written(spark, sf_dir, True))).groupBy("rule").agg(F.count("*").alias("n"), F.min("subject").alias("first_subject"))


QUERIES = {f.__name__: f for f in (replay_receipt, replay_findings)}

_KINDS = "kind IN ('view', 'click', 'purchase')"
ORACLE = {
    "replay_receipt": f"WITH {OBS} SELECT 'all' AS replay_id, 3::BIGINT AS source_count, (SELECT count(*) FROM nation) AS member_count, count(*) AS observation_count, count(DISTINCT ts) AS timestamp_count, true AS sealed FROM obs WHERE {_KINDS}",
    "replay_findings": f"""WITH {OBS}, o AS (SELECT 'o' || obs_id AS id, *, obs_id % 25 AS key, CASE WHEN obs_id % 13 = 0 THEN 'none' WHEN obs_id % 17 = 0 THEN 'view' ELSE kind END AS source FROM obs WHERE {_KINDS}), f AS (
 SELECT 'unsafe member path' AS rule, '../outside.txt' AS subject UNION ALL SELECT 'missing member', 'frames/f3.txt' UNION ALL SELECT 'content replaced', 'frames/f4.txt' UNION ALL SELECT 'overlapping gaps', 's-view'
 UNION ALL SELECT 'unknown source_id', id FROM o WHERE source = 'none' UNION ALL SELECT 'sensor_type mismatch', id FROM o WHERE source <> 'none' AND source <> kind UNION ALL SELECT 'invalid time', id FROM o WHERE obs_id % 11 = 0
 UNION ALL SELECT 'unsafe member path', id FROM o WHERE kind = 'click' AND key = 5 UNION ALL SELECT 'undeclared member', id FROM o WHERE kind = 'click' AND key IN (3, 4))
 SELECT rule, count(*) AS n, min(subject) AS first_subject FROM f GROUP BY 1""",
}
