"""Queries: governed values with their provenance, shapes of tracks and hashes of pictures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pictures as P
from ..sources import governed as V
from .mapping import OBS, observations, table


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a registry: a value, a status and a version each."""
    n = table(spark, sf_dir, "nation")
    status = F.element_at(F.array(*[F.lit(s) for s in ("VALIDATED", "CANDIDATE", "PROHIBITED", "CANONICAL", "EXECUTABLE_CANDIDATE")]), (F.col("n_nationkey") % 5 + 1).cast("int"))
    value = F.when(F.col("n_nationkey") == 5, "by hand").otherwise((F.col("n_nationkey") / 25).cast("string"))
    return n.select(F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("threshold_id"), value.alias("current_value"), status.alias("status"), F.lit("stop").alias("failure_behavior"), F.concat(F.lit("v"), F.col("n_regionkey").cast("string")).alias("effective_version"))


def governed_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each entry of the registry gives: its value, or why there is none; one that is not registered is told too."""
    t = V.Thresholds(_registry(spark, sf_dir))
    rows = []
    for id_ in [*t.entries, "T99"]:
        why = "not_registered" if id_ not in t.entries else t.refusal(id_)
        kind = why if why in (None, "not_registered") else "prohibited" if "PROHIBITED" in why else "not_executable"
        found = V.number(t.entry(id_)["current_value"]) if kind is None else None
        rows.append((id_, kind or "ok", None if found is None else str(found)))
    return spark.createDataFrame(rows, "threshold_id string, outcome string, value string").withColumn("value", F.round(F.col("value").try_cast("double"), 6))


def governed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations above two governed thresholds, with the stamps of both."""
    t = V.Thresholds(_registry(spark, sf_dir))
    made = V.scored(observations(spark, sf_dir), t, ["T13", "T9"], lambda v: {"high": F.col("confidence") >= v["T13"], "low": F.col("confidence") < v["T9"]})
    stamp = F.array_join(F.transform("provenance", lambda s: F.concat_ws("/", s["threshold_id"], s["status"], s["version"])), ",")
    return made.select("obs_id", "high", "low", stamp.alias("provenance"))


def track_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of each aircraft and day: rings, bows, lines and blobs of points around its observations."""
    o = observations(spark, sf_dir).groupBy("aircraft").agg(F.count("*").alias("n"), F.min("obs_id").alias("first"))
    o = o.select("aircraft", (F.col("first") % 4).alias("form"), F.explode(F.sequence(F.lit(0), 40 + F.col("n") % 40)).alias("i"), (F.col("n") % 2).alias("parts"))
    turn = F.col("i") * 0.16
    r = F.when(F.col("form") == 0, 20.0).when(F.col("form") == 1, 12.0 + 8.0 * F.cos(2 * turn)).otherwise(F.col("i") * 1.0)
    x = F.when(F.col("form") == 2, F.col("i") * 2.0).otherwise(r * F.cos(turn))
    y = F.when(F.col("form") == 2, F.col("i") * 0.5).otherwise(r * F.sin(turn))
    points = o.select("aircraft", F.when((F.col("parts") == 1) & (F.col("i") > 35), 1).otherwise(0).alias("component"), F.round(x).cast("int").alias("x"), F.round(y).cast("int").alias("y"))
    return P.track_features(points, ["aircraft"], "component")


def picture_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average hashes and mean hues of small pictures, one for each aircraft, of 6 to 19 rows."""
    o = observations(spark, sf_dir)
    h, w = 6 + F.col("user") % 14, 8 + F.col("user") % 9
    sizes = o.groupBy("aircraft").agg(F.count("*").alias("n")).select("aircraft", F.substring("aircraft", 2, 20).cast("long").alias("user"))
    pixels = sizes.withColumn("y", F.explode(F.sequence(F.lit(0), (h - 1).cast("int")))).withColumn("x", F.explode(F.sequence(F.lit(0), (w - 1).cast("int"))))
    pixels = pixels.withColumn("grey", (F.col("y") * 37 + F.col("x") * F.col("user") * 11) % 256)
    # rounded as the SQL does, which scales the double first: 88.87755, stored just below, gives 88.8775
    hue = F.round(P.circular_mean(F.col("k") * 7.0, F.col("confidence")) * 10_000.0) / 10_000.0
    hues = o.groupBy("aircraft").agg(hue.alias("mean_hue"), F.round(F.percentile("altitude_ft", F.lit(0.9)), 6).alias("p90"))
    return P.average_hash(pixels, ["aircraft"]).join(hues, "aircraft")


QUERIES = {f.__name__: f for f in (governed_thresholds, governed_scores, track_shapes, picture_hashes)}

_STATUS = "['VALIDATED', 'CANDIDATE', 'PROHIBITED', 'CANONICAL', 'EXECUTABLE_CANDIDATE'][n_nationkey % 5 + 1]"
ORACLE = {
    "governed_thresholds": f"SELECT 'T' || n_nationkey AS threshold_id, CASE {_STATUS} WHEN 'PROHIBITED' THEN 'prohibited' WHEN 'CANDIDATE' THEN 'not_executable' ELSE 'ok' END AS outcome, CASE WHEN n_nationkey % 5 IN (0, 3, 4) AND n_nationkey <> 5 THEN round(n_nationkey / 25.0::DOUBLE, 6) END AS value FROM nation UNION ALL SELECT 'T99', 'not_registered', NULL",
    "governed_scores": f"WITH {OBS}, n AS (SELECT string_agg('T' || n_nationkey || '/' || {_STATUS} || '/v' || n_regionkey, ',' ORDER BY n_nationkey DESC) AS provenance FROM nation WHERE n_nationkey IN (9, 13)) SELECT obs_id, confidence >= 13 / 25.0::DOUBLE AS high, confidence < 9 / 25.0::DOUBLE AS low, provenance FROM obs, n",
    "picture_hashes": f"""WITH {OBS}, s AS (SELECT DISTINCT aircraft, CAST(substr(aircraft, 2) AS BIGINT) AS u FROM obs), p AS (SELECT aircraft, 6 + u % 14 AS h, 8 + u % 9 AS w, y, x, (y * 37 + x * u * 11) % 256 AS grey FROM s, range(19) a(y), range(17) b(x) WHERE y < 6 + u % 14 AND x < 8 + u % 9),
 c AS (SELECT aircraft, r.b AS y, q.b AS x, avg(grey) AS c FROM p, range(8) r(b), range(8) q(b) WHERE p.y >= r.b * h // 8 AND p.y < greatest(r.b * h // 8 + 1, (r.b + 1) * h // 8) AND p.x >= q.b * w // 8 AND p.x < greatest(q.b * w // 8 + 1, (q.b + 1) * w // 8) GROUP BY 1, 2, 3),
 m AS (SELECT *, sum(c) OVER (PARTITION BY aircraft) / 64 AS mean FROM c), h AS (SELECT aircraft, string_agg(CASE WHEN c >= mean THEN '1' ELSE '0' END, '' ORDER BY y, x) AS b FROM m GROUP BY 1),
 v AS (SELECT aircraft, sum(confidence * cos(radians(k * 7.0))) AS a, sum(confidence * sin(radians(k * 7.0))) AS b, round(quantile_cont(altitude_ft, 0.9), 6) AS p90 FROM obs GROUP BY 1)
 SELECT h.aircraft, string_agg(['0','1','2','3','4','5','6','7','8','9','a','b','c','d','e','f'][8 * CAST(substr(h.b, 4 * i + 1, 1) AS INT) + 4 * CAST(substr(h.b, 4 * i + 2, 1) AS INT) + 2 * CAST(substr(h.b, 4 * i + 3, 1) AS INT) + CAST(substr(h.b, 4 * i + 4, 1) AS INT) + 1], '' ORDER BY i) AS hash, round((round(degrees(atan2(v.b, a)), 6) + 360) % 360, 4) AS mean_hue, p90 FROM h JOIN v ON v.aircraft = h.aircraft, range(16) t(i) GROUP BY 1, 3, 4""",
}
