"""How the supplied tables stand for the domain's: one place for the DataFrame and its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(k: Column) -> Column:
    return F.lit(17.92) + F.lit(0.73) * ((k * 37) % 1000).cast("double") / F.lit(999.0)


def lon_of(k: Column) -> Column:
    return F.lit(-67.30) + F.lit(2.10) * ((k * 91) % 1000).cast("double") / F.lit(999.0)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as aircraft observations."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        i.alias("obs_id"),
        F.concat(F.lit("N"), F.col("user_id").cast("string")).alias("aircraft"),
        F.col("ts"),
        F.col("event_type").alias("kind"),
        F.col("value"),
        lat_of(i).alias("lat"),
        lon_of(i).alias("lon"),
        (i * 131 % 12000).alias("altitude_ft"),
        (i * 17 % 220).cast("double").alias("speed_mph"),
        ((i * 7 % 101).cast("double") / F.lit(100.0)).alias("confidence"),
        (F.col("user_id") % 4).cast("string").alias("corridor_id"),
        F.date_format("ts", "yyyy-MM").alias("month"),
        F.to_date("ts").alias("day"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


OBS = """obs AS (SELECT event_id AS obs_id, 'N' || CAST(user_id AS VARCHAR) AS aircraft, ts, event_type AS kind, value,
 CAST(17.92 AS DOUBLE) + CAST(0.73 AS DOUBLE) * CAST((event_id * 37) % 1000 AS DOUBLE) / CAST(999.0 AS DOUBLE) AS lat,
 CAST(-67.30 AS DOUBLE) + CAST(2.10 AS DOUBLE) * CAST((event_id * 91) % 1000 AS DOUBLE) / CAST(999.0 AS DOUBLE) AS lon,
 event_id * 131 % 12000 AS altitude_ft, CAST(event_id * 17 % 220 AS DOUBLE) AS speed_mph,
 CAST(event_id * 7 % 101 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS confidence, CAST(user_id % 4 AS VARCHAR) AS corridor_id,
 strftime(ts, '%Y-%m') AS month, CAST(ts AS DATE) AS day, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as airports."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("long")
    return n.select(k.alias("airport_id"), F.col("n_name").alias("airport"), lat_of(k * 13).alias("a_lat"), lon_of(k * 13).alias("a_lon"))


AIR = """air AS (SELECT CAST(n_nationkey AS BIGINT) AS airport_id, n_name AS airport,
 CAST(17.92 AS DOUBLE) + CAST(0.73 AS DOUBLE) * CAST((CAST(n_nationkey AS BIGINT) * 13 * 37) % 1000 AS DOUBLE) / CAST(999.0 AS DOUBLE) AS a_lat,
 CAST(-67.30 AS DOUBLE) + CAST(2.10 AS DOUBLE) * CAST((CAST(n_nationkey AS BIGINT) * 13 * 91) % 1000 AS DOUBLE) / CAST(999.0 AS DOUBLE) AS a_lon FROM nation)"""


def hav_sql(a: str, b: str, c: str, d: str, r: float) -> str:
    """Great-circle distance in SQL, term for term as the Column expression."""
    x = f"(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))"
    return f"CAST({2 * r} AS DOUBLE) * asin(sqrt(least(CAST(1.0 AS DOUBLE), {x})))"
