"""Grouped computations with stable ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_first(rows: DataFrame, by: list[str], value: str, seen: str) -> DataFrame:
    """(by, value, n): each group's commonest value, the first seen among equals; nulls are not counted."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), F.min(seen).alias("_s"))
    best = counted.groupBy(*by).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("_s"))).alias("_b"))
    return best.select(*by, f"_b.{value}", "_b.n")


def top_k(rows: DataFrame, by: list[str], k: int, order: list[Column]) -> DataFrame:
    """The first k rows of each group, with `rank` from 1."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def baselines(rows: DataFrame) -> DataFrame:
    """Counts, mean confidence and population deviation by corridor and domain."""
    return rows.groupBy(
        F.coalesce(F.nullif("corridor_id", F.lit("")), F.lit("unassigned")).alias("corridor_id"),
        F.coalesce(F.nullif("domain", F.lit("")), F.lit("context")).alias("domain"),
    ).agg(
        F.sum(F.coalesce("event_count", F.lit(1.0))).alias("historical_count"),
        F.avg(F.coalesce("confidence", F.lit(0.0))).alias("mean_confidence"),
        F.stddev_pop(F.coalesce("event_count", F.lit(1.0))).alias("count_stddev"),
    )


#: Governed weights and review bands of the anomaly score.
RATIO_WEIGHT, CONFIDENCE_WEIGHT = 0.65, 0.35
REVIEW = ((0.80, "high_review"), (0.60, "moderate_review"), (0.40, "low_review"))


def anomalies(current: DataFrame, history: DataFrame) -> DataFrame:
    """Current groups scored against history; those below the lowest band are left out."""
    ratio = F.when(F.coalesce("historical_count", F.lit(0.0)) <= 0, 1.0).otherwise(
        F.col("current_count") / F.greatest("historical_count", F.lit(1e-300))
    )
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.abs(F.col("ratio") - 1.0)))
    sure = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("confidence")))
    band = F.lit("suppress")
    for least, name in reversed(REVIEW):
        band = F.when(F.col("anomaly_score") >= least, name).otherwise(band)
    return (
        current.join(history, ["corridor_id", "domain"], "left")
        .withColumn("ratio", ratio)
        .withColumn("anomaly_score", F.round(RATIO_WEIGHT * part + CONFIDENCE_WEIGHT * sure, 3))
        .withColumn("review_band", band)
        .where("review_band <> 'suppress'")
        .select("corridor_id", "domain", "current_count", F.coalesce("historical_count", F.lit(0.0)).alias("historical_count"), "confidence", "anomaly_score", "review_band")
    )


def reliability_bins(rows: DataFrame, by: str, score: str, truth: str, bins: int = 10) -> DataFrame:
    """Expected against observed share by detector and score bin."""
    at = F.least(F.lit(bins - 1), (F.col(score) * bins).cast("int"))
    return rows.groupBy(by, at.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("expected"), F.avg(F.col(truth).cast("double")).alias("observed")
    ).withColumn("gap", F.col("observed") - F.col("expected"))


def affine_fit(rows: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """Least-squares line y = a + b x for each group, with the number of points."""
    return rows.groupBy(by).agg(
        F.regr_intercept(y, x).alias("a"), F.regr_slope(y, x).alias("b"), F.count("*").alias("n")
    )
