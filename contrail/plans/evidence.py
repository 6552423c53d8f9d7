"""Queries: evidence scores of imagery detectors over signal maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import evidence as E
from ..functions.geo import band, clamp01
from .mapping import OBS, observations


def _signal(i: int) -> Column:
    """The i-th signal of an observation, on a grid of hundredths from -0.1 to 1.1."""
    return ((F.col("obs_id") * (3 + 2 * i) + 7 * i) % 121 - 10).cast("double") / F.lit(100.0)


def _signal_sql(i: int) -> str:
    return f"(CAST((obs_id * {3 + 2 * i} + {7 * i}) % 121 - 10 AS DOUBLE) / CAST(100.0 AS DOUBLE))"


def _link(i: int) -> Column:
    return (F.col("obs_id") + i) % (i + 2) == 0


def _link_sql(i: int) -> str:
    return f"((obs_id + {i}) % {i + 2} = 0)"


def _scale(family: E.Family) -> float:
    """Signals of families that do not round their contributions are no hundredths, so that it shows."""
    return 1.0 if family.rounded else 0.937113


def _maps(o: DataFrame, family: E.Family) -> DataFrame:
    signals = F.create_map(*[x for i, k in enumerate(family.signals) for x in (F.lit(k), _signal(i) * _scale(family))])
    links = F.create_map(*[x for i, k in enumerate(family.links) for x in (F.lit(k), _link(i))])
    return o.select("obs_id", "confidence", signals.alias("signals"), links.alias("links"))


def _clamp_sql(x: str) -> str:
    return f"greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), {x}))"


def _family(name: str):
    family = E.FAMILIES[name]
    water = name == "water"

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _maps(observations(spark, sf_dir), family)
        score = E.combined_score(F.col("signals"), F.col("links"), family)
        artifact = F.col("confidence") * 0.7391 + 0.0013713
        if water:
            artifact = F.bround(artifact, 4)
        scored = m.select("*", E.signal_score(F.col("signals"), family).alias("signal_score"), E.link_score(F.col("links"), family).alias("link_score"), score.alias("combined_score"), E.discounted(score, artifact).alias("adjusted_score"))
        more = [band(F.col("adjusted_score" if family.adjusted_band else "combined_score")).alias("band")]
        if water:
            classes = F.when(F.col("obs_id") % 4 > 0, F.array(F.lit("PERMANENT_POND")))
            more.append(F.array_join(E.review_reasons(F.col("adjusted_score"), artifact, classes, F.col("signals")), ",").alias("reasons"))
        return scored.select("obs_id", "signal_score", "link_score", "combined_score", "adjusted_score", *more)

    one = lambda i, w: f"{_clamp_sql(f'{_signal_sql(i)} * CAST({_scale(family)} AS DOUBLE)')} * CAST({w} AS DOUBLE)"
    parts = " + ".join(f"round_even({one(i, w)}, 4)" if family.rounded else one(i, w) for i, w in enumerate(family.signals.values()))
    links = " + ".join(f"CASE WHEN {_link_sql(i)} THEN CAST({w} AS DOUBLE) ELSE 0 END" for i, w in enumerate(family.links.values()))
    artifact = "(confidence * CAST(0.7391 AS DOUBLE) + CAST(0.0013713 AS DOUBLE))"
    if water:
        artifact = f"round({artifact}, 4)"
    by = "adjusted_score" if family.adjusted_band else "combined_score"
    less = f"round_even(round(combined_score * (1.0 - CAST(0.5 AS DOUBLE) * {artifact}), 9), 4)"
    if water:  # both factors have four digits, so ties are found in whole numbers
        n = f"CAST(round(combined_score * 10000) AS BIGINT) * (20000 - CAST(round({artifact} * 10000) AS BIGINT))"
        less = f"({n} // 20000 + CASE WHEN {n} % 20000 > 10000 OR {n} % 20000 = 10000 AND {n} // 20000 % 2 = 1 THEN 1 ELSE 0 END) / CAST(10000 AS DOUBLE)"
    reasons = f""", concat_ws(',', CASE WHEN {artifact} >= 0.7 THEN 'HIGH_ARTIFACT_CONFIDENCE' END, CASE WHEN adjusted_score < 0.4 THEN 'LOW_ADJUSTED_CONFIDENCE' END, CASE WHEN obs_id % 4 = 0 THEN 'UNKNOWN_WATER_CLASS' END) AS reasons"""
    sql = f"""WITH {OBS}, s AS (SELECT obs_id, confidence, round({_clamp_sql(parts)}, 4) AS signal_score, round({_clamp_sql(links)}, 4) AS link_score FROM obs),
 c AS (SELECT *, round({_clamp_sql('signal_score + link_score')}, 4) AS combined_score FROM s),
 a AS (SELECT *, {less} AS adjusted_score FROM c)
 SELECT obs_id, signal_score, link_score, combined_score, adjusted_score, CASE WHEN {by} >= 0.7 THEN 'HIGH' WHEN {by} >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS band{reasons if water else ''} FROM a"""
    query.__name__ = f"{name}_scores"
    return query, sql


# The weights of a gap's components.
GAP_WEIGHTS = {
    "gap_duration": 0.10,
    "endpoint_segment_proximity": 0.25,
    "temporal_alignment": 0.20,
    "heading_compatibility": 0.15,
    "altitude_speed_continuity": 0.10,
    "repeat_gridid_overlap": 0.10,
    "visual_feature_proximity": 0.10,
}


def route_gap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted mean over the components there are, and the penalty for those missing."""
    o = observations(spark, sf_dir)
    o = o.select("obs_id", *[F.when((F.col("obs_id") + i) % 4 != 0, clamp01(_signal(i) * 0.9371)).alias(k) for i, k in enumerate(GAP_WEIGHTS)])
    mean, penalty = E.available_mean([(F.col(k), w) for k, w in GAP_WEIGHTS.items()])
    return o.select("obs_id", mean.alias("raw_score"), penalty.alias("missing_penalty"))


_GAP = {k: f"CASE WHEN (obs_id + {i}) % 4 <> 0 THEN {_clamp_sql(_signal_sql(i) + ' * CAST(0.9371 AS DOUBLE)')} END" for i, k in enumerate(GAP_WEIGHTS)}
_GAP_SQL = f"WITH {OBS}, p AS (SELECT obs_id, {', '.join(f'{x} AS {k}' for k, x in _GAP.items())} FROM obs) SELECT obs_id, round(coalesce(({' + '.join(f'coalesce({k} * CAST({w} AS DOUBLE), 0)' for k, w in GAP_WEIGHTS.items())}) / nullif({' + '.join(f'CASE WHEN {k} IS NULL THEN 0 ELSE CAST({w} AS DOUBLE) END' for k, w in GAP_WEIGHTS.items())}, 0), 0), 4) AS raw_score, round(least(CAST(0.35 AS DOUBLE), ({' + '.join(f'CASE WHEN {k} IS NULL THEN 1 ELSE 0 END' for k in GAP_WEIGHTS)}) * CAST(0.05 AS DOUBLE)), 4) AS missing_penalty FROM p"


def temporal_change_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest change times alignment, less for artifacts and contradictions, and its class."""
    o = observations(spark, sf_dir)
    change = F.array_max(F.array(*[clamp01(_signal(i)) for i in range(3)]))
    alignment = F.bround(sum((clamp01(_signal(i)) for i in range(4, 7)), clamp01(_signal(3))) / 4.0, 4)
    s = o.select("obs_id", change.alias("change_score"), alignment.alias("alignment_score"), clamp01(_signal(7)).alias("artifact"), clamp01(_signal(8)).alias("contradiction"))
    adjusted = F.bround(F.col("change_score") * F.col("alignment_score") * (1.0 - 0.6 * F.col("artifact")) * (1.0 - 0.3 * F.col("contradiction")), 4)
    s = s.withColumn("adjusted", adjusted)
    kind = F.when(F.col("alignment_score") < 0.6, "INSUFFICIENT_EPOCH_ALIGNMENT").when((F.col("artifact") >= 0.7) & (F.col("change_score") >= 0.35), "ARTIFACT_DRIVEN_CHANGE").when(F.col("adjusted") >= 0.7, "VISIBLE_CHANGE").when(F.col("adjusted") >= 0.35, "PROBABLE_CHANGE").otherwise("STABLE")
    return s.withColumn("class", kind)


def contradiction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    s = o.select("obs_id", F.array_max(F.array(*[clamp01(_signal(i)) for i in range(5)])).alias("conflict_score"), F.forall(F.array(_link(0), _link(1)), lambda x: x).alias("complete"))
    kind = F.when(~F.col("complete"), "INSUFFICIENT_EVIDENCE").when(F.col("conflict_score") >= 0.75, "HARD_CONTRADICTION").when(F.col("conflict_score") >= 0.35, "SOFT_CONTRADICTION").otherwise("CONSISTENT")
    s = s.withColumn("class", kind)
    factor = F.when(F.col("class") == "CONSISTENT", 1.0).when(F.col("class") == "SOFT_CONTRADICTION", 0.8).when(F.col("class") == "HARD_CONTRADICTION", 0.5).otherwise(0.65)
    return s.withColumn("confidence_multiplier", factor)


def tile_seam_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean votes for and against a seam; a released raw coordinate holds the row."""
    o = observations(spark, sf_dir)
    up = sum((_link(i).cast("int") for i in range(1, 4)), _link(0).cast("int"))
    down = sum((_link(i).cast("int") for i in range(5, 7)), _link(4).cast("int"))
    s = o.select("obs_id", up.alias("positive"), down.alias("negative"), _link(6).alias("released"))
    label = F.when(F.col("released"), "HOLD").when((F.col("positive") >= 3) & (F.col("negative") == 0), "TILE_SEAM").when(F.col("positive") >= 2, "POSSIBLE").otherwise("INSUFFICIENT")
    return s.withColumn("label", label)


def boundary_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The likeliest of four explanations, the first of equals, uncertain below 0.55."""
    o = observations(spark, sf_dir)
    names = ["tile_seam", "ground_feature", "cloud_shadow", "terrain_shadow"]
    scored = F.array(*[F.struct(clamp01(_signal(i)).alias("s"), F.lit(-i).alias("o"), F.lit(n).alias("n")) for i, n in enumerate(names)])
    s = o.select("obs_id", F.array_max(scored).alias("b"))
    return s.select("obs_id", F.col("b.s").alias("score"), F.when(F.col("b.s") < 0.55, "uncertain").otherwise(F.col("b.n")).alias("label"))


def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strictly above 0.85 is promoted."""
    o = observations(spark, sf_dir)
    return o.select("obs_id", F.when(clamp01(F.col("confidence")) > 0.85, "evidence_gated").otherwise("highly_speculative").alias("status"))


def marker_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top marker by aircraft and day if it is confident and clear of the runner-up, else a reason."""
    o = observations(spark, sf_dir)
    two = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("confidence", (-F.col("obs_id")).alias("o"))))), 1, 2)
    s = o.groupBy("aircraft", "day").agg(two.alias("t"))
    top, margin = F.get("t", 0)["confidence"], F.get("t", 0)["confidence"] - F.coalesce(F.get("t", 1)["confidence"], F.lit(0.0))
    reason = F.when(top < 0.55, "low_confidence").when(F.round(margin, 6) < 0.1, "ambiguous").otherwise("chosen")
    return s.select("aircraft", "day", reason.alias("reason"), F.when(reason == "chosen", -F.get("t", 0)["o"]).alias("obs_id"))


def assessment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0.08 less for each contradiction, 0.35 at most; screenshots capped at 0.74."""
    o = observations(spark, sf_dir)
    less = F.least(F.lit(0.35), F.lit(0.08) * (F.col("obs_id") % 7))
    score = F.bround(clamp01(F.col("confidence") - less), 4)
    return o.select("obs_id", F.when(F.col("kind") == "view", F.least(F.lit(0.74), score)).otherwise(score).alias("score"))


def verification_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points 35/30/15/10/10 for what a track has, in four levels."""
    o = observations(spark, sf_dir)
    s = o.select("obs_id", sum((F.when(_link(i), w).otherwise(0) for i, w in enumerate((35, 30, 15, 10, 10))), F.lit(0)).alias("points"))
    return s.withColumn("level", F.when(F.col("points") <= 25, "unverified").when(F.col("points") <= 50, "weak").when(F.col("points") <= 75, "moderate").otherwise("strong"))


_FAMILIES = [_family(n) for n in E.FAMILIES]
_PLAIN = (route_gap_scores, temporal_change_scores, contradiction_scores, tile_seam_votes, boundary_argmax, evidence_gate, marker_choice, assessment_scores, verification_levels)
QUERIES = {q.__name__: q for q, _ in _FAMILIES} | {f.__name__: f for f in _PLAIN}

_S = [_clamp_sql(_signal_sql(i)) for i in range(9)]
ORACLE = {q.__name__: s for q, s in _FAMILIES} | {
    "route_gap_scores": _GAP_SQL,
    "temporal_change_scores": f"WITH {OBS}, s AS (SELECT obs_id, greatest({_S[0]}, {_S[1]}, {_S[2]}) AS change_score, round(({_S[3]} + {_S[4]} + {_S[5]} + {_S[6]}) / CAST(4.0 AS DOUBLE), 6) AS a0, {_S[7]} AS artifact, {_S[8]} AS contradiction FROM obs), a AS (SELECT obs_id, change_score, round_even(CAST(a0 AS DECIMAL(18, 6)), 4)::DOUBLE AS alignment_score, artifact, contradiction FROM s), d AS (SELECT *, round(change_score * alignment_score * (CAST(1.0 AS DOUBLE) - CAST(0.6 AS DOUBLE) * artifact) * (CAST(1.0 AS DOUBLE) - CAST(0.3 AS DOUBLE) * contradiction), 4) AS adjusted FROM a) SELECT *, CASE WHEN alignment_score < 0.6 THEN 'INSUFFICIENT_EPOCH_ALIGNMENT' WHEN artifact >= 0.7 AND change_score >= 0.35 THEN 'ARTIFACT_DRIVEN_CHANGE' WHEN adjusted >= 0.7 THEN 'VISIBLE_CHANGE' WHEN adjusted >= 0.35 THEN 'PROBABLE_CHANGE' ELSE 'STABLE' END AS class FROM d",
    "contradiction_scores": f"WITH {OBS}, s AS (SELECT obs_id, greatest({', '.join(_S[:5])}) AS conflict_score, {_link_sql(0)} AND {_link_sql(1)} AS complete FROM obs), c AS (SELECT *, CASE WHEN NOT complete THEN 'INSUFFICIENT_EVIDENCE' WHEN conflict_score >= 0.75 THEN 'HARD_CONTRADICTION' WHEN conflict_score >= 0.35 THEN 'SOFT_CONTRADICTION' ELSE 'CONSISTENT' END AS class FROM s) SELECT *, CAST(CASE class WHEN 'CONSISTENT' THEN 1.0 WHEN 'SOFT_CONTRADICTION' THEN 0.8 WHEN 'HARD_CONTRADICTION' THEN 0.5 ELSE 0.65 END AS DOUBLE) AS confidence_multiplier FROM c",
    "tile_seam_votes": f"WITH {OBS}, s AS (SELECT obs_id, {' + '.join(f'CAST({_link_sql(i)} AS INT)' for i in range(4))} AS positive, {' + '.join(f'CAST({_link_sql(i)} AS INT)' for i in range(4, 7))} AS negative, {_link_sql(6)} AS released FROM obs) SELECT *, CASE WHEN released THEN 'HOLD' WHEN positive >= 3 AND negative = 0 THEN 'TILE_SEAM' WHEN positive >= 2 THEN 'POSSIBLE' ELSE 'INSUFFICIENT' END AS label FROM s",
    "boundary_argmax": f"WITH {OBS}, s AS (SELECT obs_id, {_S[0]} AS a, {_S[1]} AS b, {_S[2]} AS c, {_S[3]} AS d FROM obs), m AS (SELECT *, greatest(a, b, c, d) AS score FROM s) SELECT obs_id, score, CASE WHEN score < 0.55 THEN 'uncertain' WHEN a = score THEN 'tile_seam' WHEN b = score THEN 'ground_feature' WHEN c = score THEN 'cloud_shadow' ELSE 'terrain_shadow' END AS label FROM m",
    "evidence_gate": f"WITH {OBS} SELECT obs_id, CASE WHEN confidence > 0.85 THEN 'evidence_gated' ELSE 'highly_speculative' END AS status FROM obs",
    "marker_choice": f"WITH {OBS}, r AS (SELECT aircraft, day, obs_id, confidence, row_number() OVER w AS rn, lead(confidence) OVER w AS nx FROM obs WINDOW w AS (PARTITION BY aircraft, day ORDER BY confidence DESC, obs_id)), c AS (SELECT aircraft, day, obs_id, CASE WHEN confidence < 0.55 THEN 'low_confidence' WHEN round(confidence - coalesce(nx, 0.0), 6) < 0.1 THEN 'ambiguous' ELSE 'chosen' END AS reason FROM r WHERE rn = 1) SELECT aircraft, day, reason, CASE WHEN reason = 'chosen' THEN obs_id END AS obs_id FROM c",
    "assessment_scores": f"WITH {OBS}, s AS (SELECT obs_id, kind, round({_clamp_sql('confidence - least(CAST(0.35 AS DOUBLE), CAST(0.08 AS DOUBLE) * (obs_id % 7))')}, 4) AS x FROM obs) SELECT obs_id, CASE WHEN kind = 'view' THEN least(CAST(0.74 AS DOUBLE), x) ELSE x END AS score FROM s",
    "verification_levels": f"WITH {OBS}, s AS (SELECT obs_id, {' + '.join(f'CASE WHEN {_link_sql(i)} THEN {w} ELSE 0 END' for i, w in enumerate((35, 30, 15, 10, 10)))} AS points FROM obs) SELECT *, CASE WHEN points <= 25 THEN 'unverified' WHEN points <= 50 THEN 'weak' WHEN points <= 75 THEN 'moderate' ELSE 'strong' END AS level FROM s",
}
