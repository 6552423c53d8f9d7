"""Queries: corridors and water, seams and their geometry, promotion of labels, readiness, audits and choices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import seams as S
from ..functions.geo import clamp01
from ..operators import joins as J
from ..operators import patterns as P
from .evidence import _S, _link, _link_sql, _signal
from .mapping import AIR, OBS, airports, hav_sql, observations, table


def corridor_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class that a corridor's signals recommend, in the ladder's order."""
    drain, ease, asset, fence, track, clear = (clamp01(_signal(i)) for i in range(6))
    kind = F.when(drain >= 0.6, "DRAINAGE_FEATURE").when((ease >= 0.6) & (asset >= 0.4), "UTILITY_CORRIDOR").when(fence >= 0.6, "PROPERTY_BOUNDARY").when(F.greatest(track, clear) >= 0.6, "ACCESS_CORRIDOR").otherwise("UNKNOWN_LINEAR_CLEARING")
    return observations(spark, sf_dir).select("obs_id", kind.alias("class"))


def water_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a water feature needs review: artifacts, low confidence, an unknown class, no signals."""
    artifact, adjusted = clamp01(_signal(0)), clamp01(_signal(1))
    reasons = F.array(
        F.when(artifact >= 0.7, "HIGH_ARTIFACT_CONFIDENCE"), F.when(adjusted < 0.40, "LOW_ADJUSTED_CONFIDENCE"),
        F.when(_link(2), "UNKNOWN_WATER_CLASS"), F.when(_link(5), "NO_VISIBLE_SIGNAL_VALUES"),
    )
    s = observations(spark, sf_dir).select("obs_id", F.array_sort(F.array_compact(reasons)).alias("r"))
    return s.select("obs_id", F.array_join("r", ",").alias("reasons"), (F.size("r") > 0).alias("review_required"))


_SEAM = ("straight", "radiometric", "texture", "cloud", "shadow", "terrain", "persistence", "infrastructure", "right_angle")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).select("obs_id", *[clamp01(_signal(i)).alias(n) for i, n in enumerate(_SEAM)])
    o = o.withColumn("rectangular", F.col("straight") * F.col("texture")).withColumn("suppression", F.greatest("infrastructure", F.col("terrain") * 0.5))
    found = S.seam_likelihoods({c: F.col(c) for c in o.columns})
    return o.withColumns(found)


def tile_seam_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted explanations of a boundary, the likeliest above the floor."""
    o = _candidates(spark, sf_dir)
    parts = [F.round(c, 6).alias(c) for c in ("tile_seam", "cloud_shadow", "terrain_shadow", "ground")]
    return o.select("obs_id", "corroborating", *parts, S.seam_decision(F.col("suppression"), F.col("right_angle")).alias("decision"))


def strict_seam_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of eight clauses, or the overlap that explains what fails it."""
    o = _candidates(spark, sf_dir)
    extra = {"screen_locked": F.greatest("radiometric", "straight"), "track_line": F.col("cloud") * 0.6, "ui_overlay": F.col("shadow") * 0.6}
    o = o.withColumns({**extra, "straight": F.greatest("straight", "texture"), "persistence": F.col("persistence") * 0.5})
    return o.select("obs_id", S.strict_decision({c: F.col(c) for c in o.columns}).alias("decision"))


def seam_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that look like a mosaic's seam, and frames in which two of them make a corner."""
    o = observations(spark, sf_dir)
    e = o.select("aircraft", "day", "obs_id", clamp01(_signal(1) + 0.3).alias("straight"), clamp01(_signal(2)).alias("tone"), (F.col("altitude_ft") % 12 * 45.0 % 180.0 + F.col("k") % 4).alias("deg"), (F.col("k") * 3.0).alias("shift"), "speed_mph", F.lit(2.0).alias("dt"))
    seam, sure = S.seam_edge(F.col("straight"), F.col("tone"), F.col("deg"), F.col("shift"), F.col("speed_mph"), F.col("dt"))
    across, up = S.on_axis(F.col("deg"))
    e = e.withColumns({"seam": seam, "sure": sure, "across": across, "up": up})
    return e.groupBy("aircraft", "day").agg(F.count_if("seam").alias("seams"), F.round(F.max("sure"), 6).alias("confidence"), (F.bool_or(F.col("seam") & F.col("across")) & F.bool_or(F.col("seam") & F.col("up"))).alias("is_box"))


def boundary_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straightness, length and right angles of each session's line, and contrast, terrain and land cover across it."""
    o = observations(spark, sf_dir)
    order = Window.partitionBy("aircraft", "day").orderBy("ts", "obs_id")
    p = o.withColumns({"px": F.lag("lon").over(order), "py": F.lag("lat").over(order)})
    p = p.withColumn("step", F.hypot(F.col("lon") - F.col("px"), F.col("lat") - F.col("py")))
    at = F.struct("ts", "obs_id")
    g = p.groupBy("aircraft", "day").agg(
        F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"), (F.count("*") - 1).alias("segments"), F.stddev_pop("altitude_ft").alias("sd"), F.countDistinct("kind").alias("classes"),
        *[f(c, at).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("first", F.min_by), ("last", F.max_by))],
        *[F.avg(F.when(F.col("k") % 2 == i, F.col("value"))).alias(n) for i, n in enumerate(("left", "right"))],
        *[F.coalesce(F.stddev_pop(F.when(F.col("k") % 2 == i, F.col("value"))), F.lit(0.0)).alias(f"{n}_sd") for i, n in enumerate(("left", "right"))],
    )
    chord = F.hypot(F.col("last_lon") - F.col("first_lon"), F.col("last_lat") - F.col("first_lat"))
    g = g.withColumn("straightness", F.when(F.col("length") == 0, 0.0).otherwise(clamp01(chord / F.when(F.col("length") > 0, F.col("length")))))
    contrast = S.radiometric_contrast(F.coalesce("left", F.lit(0.0)), F.coalesce("right", F.lit(0.0)), F.col("left_sd"), F.col("right_sd"))
    # deviations of two whole numbers lie on rounding ties: a billionth decides them in both engines
    terrain = S.terrain_crossing(F.col("sd") / 5000.0, 1.0 - F.col("straightness"), F.lit(0.25)) + F.lit(1e-9)
    cover = S.landcover_persistence(F.col("classes"), F.col("straightness"))
    return g.select("aircraft", "day", "segments", *[F.round(c, 5).alias(n) for c, n in ((F.col("length"), "length"), (F.col("straightness"), "straightness"), (contrast, "radiometric_delta"), (terrain, "terrain_crossing"), (cover, "landcover_persistence"))])


def gis_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlay scores merged onto candidates where there are any, their alignment, and the flag that it contradicts a seam."""
    o = observations(spark, sf_dir)
    base = o.select("obs_id", "kind", F.create_map(*[x for i, n in enumerate(("road", "building", "airport", "parcel")) for x in (F.lit(n), clamp01(_signal(i)))]).alias("scores"))
    over = o.where("obs_id % 3 = 0").select("obs_id", F.create_map(F.lit("road"), F.lit(1.0), F.lit("airport"), clamp01(_signal(6))).alias("more"))
    met = base.join(over, "obs_id", "left")
    both = F.transform_values("scores", lambda k, v: F.coalesce(F.element_at("more", k), v))
    met = met.withColumn("all", F.coalesce(both, "scores"))
    score = S.infrastructure_alignment(*[F.element_at("all", n) for n in ("road", "building", "airport", "parcel")])
    met = met.withColumn("alignment", score)
    flag = (F.col("alignment") >= 0.65) & (F.col("kind") == "view")
    return met.select("obs_id", F.round("alignment", 6).alias("alignment"), F.when(flag, "infrastructure_explains_boundary").otherwise("").alias("flags"), F.when(flag, "needs_review").otherwise("kept").alias("review_state"))


_ADJUST = [("error", -0.30), ("view", -0.10), ("signup", 0.0)]
_ALIAS = [("click", "view"), ("other", "none")]


def _promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    adjust = J.small(spark.createDataFrame(_ADJUST, "resolved string, adjustment double"))
    alias = J.small(spark.createDataFrame(_ALIAS, "kind string, canonical string"))
    known = adjust.select(F.col("resolved").alias("kind"), F.lit(True).alias("own"))
    r = o.select("obs_id", "kind", "confidence", "day").join(known, "kind", "left").join(alias, "kind", "left")
    r = r.withColumn("resolved", F.when(F.col("own"), F.col("kind")).otherwise(F.coalesce("canonical", "kind"))).join(adjust, "resolved", "left")
    status = F.when(F.col("own"), "resolved").when(F.col("adjustment").isNotNull(), "aliased").otherwise("unknown")
    r = r.withColumns({"resolution": status, "resolved": F.when(status == "unknown", F.col("kind")).otherwise(F.col("resolved"))})
    r = r.withColumn("adjusted", clamp01(F.col("confidence") + F.coalesce("adjustment", F.lit(0.0))))
    choice = F.when(F.col("adjusted") >= 0.80, "candidate").when(F.col("adjusted") >= 0.70, "cross_source_required").when(F.col("adjusted") >= 0.55, "review").otherwise("suppressed")
    return r.withColumn("decision", choice)


def label_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with their class resolved, themselves or by an alias, the class's adjustment and the decision."""
    return _promoted(spark, sf_dir).select("obs_id", "resolved", "resolution", F.round("adjusted", 4).alias("adjusted"), "decision")


def calibration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of decisions, classes and resolutions, with scores and how many frames each has."""
    p = _promoted(spark, sf_dir)
    long = p.select("day", "confidence", "adjusted", F.explode(F.map_from_arrays(F.array(*map(F.lit, ("decision", "class", "resolution"))), F.array("decision", "kind", "resolution"))).alias("histogram", "bucket"))
    return long.groupBy("histogram", "bucket").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("mean_raw"), F.round(F.min("adjusted"), 4).alias("least"), F.round(F.max("adjusted"), 4).alias("most"), F.countDistinct("day").alias("frames"))


_LAYERS = ["L1_segmenter", "L2_route", "L3_ocr", "L4_aircraft_intelligence", "L5_tile_seam_shadow"]


def layer_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall readiness of each batch from its layers, with what blocks it and what is advised."""
    o = observations(spark, sf_dir)
    layer = F.element_at(F.array(*map(F.lit, _LAYERS)), (F.col("obs_id") % 5 + 1).cast("int"))
    state = F.when(F.col("k") % 9 == 0, "DEGRADED").when(F.col("k") % 11 == 0, "PARTIAL").otherwise("READY")
    last = o.groupBy("aircraft", "day", layer.alias("layer")).agg(F.max_by(state, "obs_id").alias("status"))
    wide = last.groupBy("aircraft", "day").pivot("layer", _LAYERS).agg(F.first("status"))
    bad = lambda n: F.coalesce(F.col(n), F.lit("MISSING")).isin("DEGRADED", "MISSING")
    base = bad(_LAYERS[0]) | bad(_LAYERS[1]) | bad(_LAYERS[2])
    ready = F.forall(F.array(*_LAYERS), lambda s: s == "READY")
    overall = F.when(base, "DEGRADED").when(bad(_LAYERS[3]) | bad(_LAYERS[4]), "PARTIAL").when(ready, "READY_FOR_BATCH_ANALYSIS").otherwise("PARTIAL")
    open_ = lambda names: F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(F.col(n), F.lit("MISSING")) != "READY", F.lit(n[:2])) for n in names])), ",")
    return wide.select("aircraft", "day", overall.alias("status"), open_(_LAYERS[:3]).alias("blocking"), open_(_LAYERS[3:]).alias("advised"))


def registry_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings by tail: whether a token of the registry stands in what is known of them, whether they are seen often enough to be
    taken in (three times, and no token themselves), and how many rows name a known gap. Suppliers are the registry, with
    their tails and nations as tokens."""
    s, n, c = (table(spark, sf_dir, t) for t in ("supplier", "nation", "customer"))
    tail = lambda k: F.concat(F.lit("N"), F.col(k).cast("string"))
    listed = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.explode(F.array(F.concat(F.lit("N"), (F.col("s_suppkey") * 7).cast("string")), F.upper("n_name"))).alias("token")).distinct()
    o = observations(spark, sf_dir).withColumn("tail", F.upper("aircraft"))
    seen = o.groupBy("tail").agg(F.count("*").alias("sightings"), F.count_if(F.col("kind") == "error").alias("gap_hits"), F.max("kind").alias("kind"))
    owners = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(tail("c_custkey").alias("tail"), F.when(F.col("c_acctbal") < 2000, F.col("n_name")).otherwise(F.col("c_mktsegment")).alias("operator"))
    hay = seen.join(owners, "tail", "left").withColumn("hay", F.upper(F.concat_ws(" ", "tail", "operator", "kind")))
    known = P.contained(hay.select("tail", "hay"), "hay", listed, "token").select("tail", F.lit(True).alias("known")).distinct()
    exact = listed.select(F.col("token").alias("tail"), F.lit(True).alias("listed"))
    met = seen.join(known, "tail", "left").join(exact, "tail", "left")
    return met.select("tail", "sightings", "gap_hits", F.coalesce("known", F.lit(False)).alias("covered"), ((F.col("sightings") >= 3) & F.col("listed").isNull()).alias("onboard"))


_RESOLUTION = "CASE obs_id % 6 WHEN 0 THEN ' Confirmed by two' WHEN 1 THEN 'REJECTED' WHEN 2 THEN 'false_positive' WHEN 3 THEN '' WHEN 4 THEN 'unclear' ELSE 'persists' END"


def review_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed items as truths: what their resolution says, with the class and confidence of their metadata."""
    o = observations(spark, sf_dir).selectExpr("obs_id", f"{_RESOLUTION} AS resolution", "CASE WHEN k % 10 = 0 THEN 'not json' ELSE concat('{\"fp\": \"', kind, '\", \"confidence\": ', k, '}') END AS metadata")
    said = F.lower(F.trim("resolution"))
    flag = F.when(said.rlike("confirmed|approved|real|persists|accept|tp"), "0").when(said.rlike("rejected|false_positive|artifact|fr24_only|suppress|fp"), "1")
    m = F.from_json("metadata", "fp string, confidence long")
    return o.select("obs_id", flag.alias("is_false_positive"), m["fp"].alias("false_positive_class"), m["confidence"].alias("confidence")).where("is_false_positive is not null and false_positive_class is not null")


def ocr_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means by zone and variant, and how each variant's hits differ from the baseline's."""
    o = observations(spark, sf_dir)
    v = F.element_at(F.array(*map(F.lit, ("baseline", "sharp", "upscaled"))), (F.col("k") % 3 + 1).cast("int"))
    g = o.groupBy(F.col("kind").alias("zone"), v.alias("variant")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("conf"), F.round(F.avg(F.col("altitude_ft") % 40), 4).alias("words"), F.avg(F.col("obs_id") % 7).alias("hits"), F.round(F.avg("value"), 4).alias("seconds"))
    base = g.where("variant = 'baseline'").select("zone", F.col("hits").alias("b"))
    return g.join(base, "zone", "left").select("zone", "variant", "n", "conf", "words", F.round("hits", 4).alias("hits"), "seconds", F.when(F.col("variant") != "baseline", F.round(F.col("hits") - F.col("b"), 4)).alias("delta"))


def best_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest artifact-bearing candidate of each frame, the first of equals, as an assessment."""
    o = observations(spark, sf_dir).where("kind in ('view', 'error')")
    best = o.groupBy("aircraft", "day").agg(F.max(F.struct("confidence", (-F.col("obs_id")).alias("o"), "kind")).alias("b"), F.count("*").alias("candidates"))
    label = F.when(F.col("b.kind") == "view", "TILE_SEAM").otherwise("SHADOW")
    return best.select("aircraft", "day", (-F.col("b.o")).alias("obs_id"), label.alias("artifact"), F.least(F.lit(0.74), F.col("b.confidence")).alias("score"), "candidates")


def legacy_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer reports in the older form: a status, flag rows and summed candidates."""
    o = observations(spark, sf_dir)
    layers = o.groupBy("corridor_id").agg(F.collect_set(F.struct("kind")).alias("k"), F.count("*").alias("n"))
    rows = layers.select("corridor_id", F.explode("k.kind").alias("layer"))
    n = o.groupBy("corridor_id", F.col("kind").alias("layer")).agg(F.count_if(F.col("confidence") >= 0.9).alias("candidates"), F.count_if(F.col("k") < 5).alias("flags"))
    met = rows.join(n, ["corridor_id", "layer"])
    return met.groupBy("corridor_id").agg(F.sum("candidates").alias("candidates"), F.count_if(F.col("flags") > 20).alias("flagged_layers"), F.when(F.bool_or(F.col("flags") > 20), "needs_calibration").otherwise("calibrated").alias("status"))


def infrastructure_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step scores of the distance to the nearest place and of the depth of water."""
    o = observations(spark, sf_dir).select("obs_id", "lat", "lon", "altitude_ft")
    best = J.nearest(o, airports(spark, sf_dir), "obs_id", ("lat", "lon"), ("a_lat", "a_lon"), [F.col("airport_id")])
    nm = geo.haversine(F.col("lat"), F.col("lon"), F.col("a_lat"), F.col("a_lon"), "nm")
    depth = F.abs(F.col("altitude_ft") / 4.0)
    strict = lambda steps: [(x - 1e-9, s) for x, s in steps]  # noqa: E731  below the limit
    return best.select("obs_id", S.step_down(nm, [(2, 1.0), (5, 0.75), (10, 0.5), (20, 0.25)], 0.1).alias("infrastructure"), S.step_down(depth, strict([(50, 0.9), (200, 0.6), (1000, 0.4)]), 0.2).alias("hydro"))


_FIELDS = ("callsign", "altitude")


def field_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields chosen between whole image and region: disagreement goes to review, else what is there, the preferred region
    or the surer one."""
    o = observations(spark, sf_dir)
    pick = lambda m, v: F.when(F.col("k") % m == 0, "").otherwise(v)
    o = o.select("obs_id", "k", pick(3, F.col("aircraft")).alias("callsign_wi"), pick(4, F.when(F.col("k") % 5 == 0, F.lit("OTHER")).otherwise(F.lower("aircraft"))).alias("callsign_rg"), pick(2, F.col("altitude_ft").cast("string")).alias("altitude_wi"), pick(5, F.col("altitude_ft").cast("string")).alias("altitude_rg"), F.when(F.col("obs_id") % 2 == 0, "right_panel").otherwise("bottom_timeline").alias("region"), "confidence")
    out = o
    for f in _FIELDS:
        wi, rg = F.col(f"{f}_wi"), F.col(f"{f}_rg")
        clash = (wi != "") & (rg != "") & (F.lower(F.trim(wi)) != F.lower(F.trim(rg)))
        region = F.concat(F.lit("region:"), F.col("region"))
        prefer = ((F.lit(f) == "altitude") & (F.col("region") == "right_panel")) | (F.col("confidence") < 0.5)
        source = F.when(clash, "disagreement").when((wi != "") & (rg == ""), "whole_image").when((wi == "") & (rg != ""), region).when((wi == "") & (rg == ""), "missing").when(prefer, region).otherwise("whole_image")
        out = out.withColumn(f"{f}_source", source)
        out = out.withColumn(f, F.when(F.col(f"{f}_source") == "whole_image", wi).when(F.col(f"{f}_source").startswith("region"), rg).otherwise(""))
    named = lambda what: F.array_join(F.array_compact(F.array(*[F.when(F.col(f"{f}_source") == what, f) for f in _FIELDS])), ";")
    used = F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*[f"{f}_source" for f in _FIELDS]), lambda s: ~s.isin("missing", "disagreement")))), ";")
    return out.select("obs_id", *_FIELDS, named("disagreement").alias("disagreements"), named("missing").alias("missing"), used.alias("sources"))


def review_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten points a conflict, more by status, and five times the confidence; highest first with ties by id."""
    o = observations(spark, sf_dir)
    conflicts = F.size(F.filter(F.split(F.when(F.col("k") % 4 == 0, "").when(F.col("k") % 4 == 1, "callsign").otherwise("callsign, ,altitude"), ","), lambda x: F.trim(x) != ""))
    status = F.when(F.col("kind") == "error", 20.0).when(F.col("kind") == "view", 5.0).otherwise(0.0)
    s = o.select("obs_id", "corridor_id", F.round(conflicts * 10.0 + status + F.col("confidence") * 5.0, 2).alias("priority"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("corridor_id").orderBy(F.desc("priority"), "obs_id")))


def heading_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of screens from speeds and headings: hover, several headings at least 60 degrees apart, or a line."""
    o = observations(spark, sf_dir)
    o = o.select("aircraft", "day", F.when(F.col("k") % 5 == 0, F.lit(None)).when(F.col("k") % 37 == 0, 0.0).otherwise(F.col("speed_mph") + 1).alias("speed"), F.when(F.col("k") % 3 > 0, F.col("altitude_ft") % 360).alias("heading"))
    g = o.groupBy("aircraft", "day").agg(F.bool_or(F.col("speed") == 0).alias("hover"), F.collect_set("heading").alias("h"), F.bool_or((F.col("speed") > 0) & F.col("heading").isNotNull()).alias("moves"))
    apart = F.exists("h", lambda a: F.exists("h", lambda b: F.least(F.abs(a - b), 360 - F.abs(a - b)) >= 60))
    shape = F.when(F.coalesce("hover", F.lit(False)), "hover").when(apart, "multi").when(F.coalesce("moves", F.lit(False)), "linear").otherwise("absent")
    return g.select("aircraft", "day", shape.alias("shape"))


# Families of artifacts by their words, the first that is met.
_WORDS = [("TRACK_LINE", "high", "fr24|route|playback|diagonal line|track"), ("UI_OVERLAY", "high", "logo|player|label|overlay"), ("ZOOM_BLUR", "high", "zoom|blur|smear"), ("SHADOW_CONFUSION", "medium", "shadow|canopy|forest"), ("TILE_SEAM", "medium", "tile|epoch|mosaic|seam"), ("COMPRESSION", "medium", "compression|jpeg|artifact")]
_NOTES = "CASE k % 9 WHEN 0 THEN 'FR24 Route' WHEN 1 THEN 'a Label' WHEN 2 THEN 'smeared zoom' WHEN 3 THEN 'forest edge' WHEN 4 THEN 'Mosaic' WHEN 5 THEN 'JPEG' WHEN 6 THEN 'tile under a canopy' ELSE 'nothing' END"


def artifact_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact class and risk by the words of all columns; only blank ones are filled."""
    o = observations(spark, sf_dir).selectExpr("obs_id", f"{_NOTES} AS note", "CASE obs_id % 4 WHEN 0 THEN 'KEPT' WHEN 1 THEN 'STRUCTURAL_SIGNAL' ELSE '' END AS artifact_class", "CASE WHEN obs_id % 5 = 0 THEN 'set' ELSE '' END AS artifact_risk")
    hay = F.lower(F.concat_ws(" ", "note", "artifact_class", "artifact_risk"))
    kind, risk = F.lit("HOLD_REVIEW"), F.lit("low")
    for k, r, words in reversed(_WORDS):
        kind, risk = F.when(hay.rlike(words), k).otherwise(kind), F.when(hay.rlike(words), r).otherwise(risk)
    return o.select("obs_id", F.when(F.col("artifact_class").isin("", "STRUCTURAL_SIGNAL"), kind).otherwise(F.col("artifact_class")).alias("artifact_class"), F.when(F.col("artifact_risk") == "", risk).otherwise(F.col("artifact_risk")).alias("artifact_risk"))


QUERIES = {
    f.__name__: f
    for f in (
        corridor_classes, water_reviews, tile_seam_classes, strict_seam_gate, seam_edges, boundary_features, gis_overlay, label_promotion, calibration_summary, layer_readiness, registry_audit, review_harvest, ocr_benchmark,
        best_assessments, legacy_status, infrastructure_steps, field_choices, review_priorities, heading_shapes, artifact_families,
    )
}

_CAND = f"""{OBS}, c0 AS (SELECT obs_id, {', '.join(f'{_S[i]} AS {n}' for i, n in enumerate(_SEAM))} FROM obs), c1 AS (SELECT *, straight * texture AS rectangular, greatest(infrastructure, terrain * CAST(0.5 AS DOUBLE)) AS suppression, greatest(cloud, shadow) AS hidden FROM c0),
 c2 AS (SELECT *, CAST(straight >= 0.55 AS INT) + CAST(radiometric >= 0.55 AS INT) + CAST(texture >= 0.55 AS INT) + CAST(rectangular >= 0.55 AS INT) + CAST(persistence <= 0.35 AS INT) + CAST(terrain <= 0.35 AS INT) AS corroborating,
 least(1.0, CAST(0.28 AS DOUBLE) * straight + CAST(0.27 AS DOUBLE) * radiometric + CAST(0.1 AS DOUBLE) * texture + CAST(0.1 AS DOUBLE) * rectangular + CAST(0.05 AS DOUBLE) * right_angle + CAST(0.15 AS DOUBLE) * (1 - persistence) + CAST(0.15 AS DOUBLE) * (1 - terrain)) AS b0 FROM c1),
 c3 AS (SELECT *, CASE WHEN right_angle >= 0.55 AND corroborating < 2 THEN least(b0, CAST(0.49 AS DOUBLE)) ELSE b0 END AS tile_base FROM c2),
 c AS (SELECT *, tile_base * (1 - CAST(0.45 AS DOUBLE) * suppression) AS tile_seam, least(1.0, hidden * greatest(radiometric, texture, CAST(0.1 AS DOUBLE))) AS cloud_shadow, least(1.0, terrain * greatest(shadow, radiometric, texture)) AS terrain_shadow, least(1.0, (persistence + infrastructure + suppression + (1 - hidden)) / CAST(4.0 AS DOUBLE)) AS ground FROM c3)"""
_PROMO = f"""{OBS}, p AS (SELECT obs_id, kind, confidence, day, CASE kind WHEN 'click' THEN 'view' ELSE kind END AS resolved, CASE WHEN kind IN ('error', 'view', 'signup') THEN 'resolved' WHEN kind = 'click' THEN 'aliased' ELSE 'unknown' END AS resolution,
 greatest(0.0, least(1.0, confidence + CASE WHEN kind = 'error' THEN CAST(-0.3 AS DOUBLE) WHEN kind IN ('view', 'click') THEN CAST(-0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)) AS adjusted FROM obs),
 q AS (SELECT *, CASE WHEN adjusted >= 0.8 THEN 'candidate' WHEN adjusted >= 0.7 THEN 'cross_source_required' WHEN adjusted >= 0.55 THEN 'review' ELSE 'suppressed' END AS decision FROM p)"""
_STATE = "CASE WHEN k % 9 = 0 THEN 'DEGRADED' WHEN k % 11 = 0 THEN 'PARTIAL' ELSE 'READY' END"
_L = [f"coalesce(max(status) FILTER (layer = {i}), 'MISSING') AS l{i + 1}" for i in range(5)]
_HAY = "lower(note || ' ' || a || ' ' || r)"
ORACLE = {
    "corridor_classes": f"WITH {OBS} SELECT obs_id, CASE WHEN {_S[0]} >= 0.6 THEN 'DRAINAGE_FEATURE' WHEN {_S[1]} >= 0.6 AND {_S[2]} >= 0.4 THEN 'UTILITY_CORRIDOR' WHEN {_S[3]} >= 0.6 THEN 'PROPERTY_BOUNDARY' WHEN {_S[4]} >= 0.6 OR {_S[5]} >= 0.6 THEN 'ACCESS_CORRIDOR' ELSE 'UNKNOWN_LINEAR_CLEARING' END AS class FROM obs",
    "water_reviews": f"WITH {OBS}, r AS (SELECT obs_id, concat_ws(',', CASE WHEN {_S[0]} >= 0.7 THEN 'HIGH_ARTIFACT_CONFIDENCE' END, CASE WHEN {_S[1]} < 0.4 THEN 'LOW_ADJUSTED_CONFIDENCE' END, CASE WHEN {_link_sql(5)} THEN 'NO_VISIBLE_SIGNAL_VALUES' END, CASE WHEN {_link_sql(2)} THEN 'UNKNOWN_WATER_CLASS' END) AS reasons FROM obs) SELECT *, reasons <> '' AS review_required FROM r",
    "tile_seam_classes": f"WITH {_CAND}, b AS (SELECT *, greatest(tile_seam, cloud_shadow, terrain_shadow, ground) AS best FROM c) SELECT obs_id, corroborating, round(tile_seam, 6) AS tile_seam, round(cloud_shadow, 6) AS cloud_shadow, round(terrain_shadow, 6) AS terrain_shadow, round(ground, 6) AS ground, CASE WHEN suppression >= 0.7 AND right_angle >= 0.55 AND tile_base >= 0.45 THEN 'explainable_infrastructure' WHEN best < 0.55 THEN 'indeterminate' WHEN tile_seam = best THEN 'probable_tile_seam' WHEN cloud_shadow = best THEN 'probable_cloud_shadow' WHEN terrain_shadow = best THEN 'probable_terrain_shadow' ELSE 'probable_ground_feature' END AS decision FROM b",
    "strict_seam_gate": f"WITH {_CAND} SELECT obs_id, CASE WHEN greatest(straight, texture) >= 0.85 AND radiometric >= 0.55 AND greatest(radiometric, straight) >= 0.7 AND persistence * CAST(0.5 AS DOUBLE) < 0.35 AND terrain_shadow < 0.55 AND ground < 0.55 AND cloud * CAST(0.6 AS DOUBLE) < 0.55 AND shadow * CAST(0.6 AS DOUBLE) < 0.55 THEN 'probable_tile_seam' WHEN cloud * CAST(0.6 AS DOUBLE) >= 0.55 THEN 'probable_track_line' WHEN shadow * CAST(0.6 AS DOUBLE) >= 0.55 THEN 'probable_ui_overlay' ELSE 'indeterminate' END AS decision FROM c",
    "seam_edges": f"WITH {OBS}, e AS (SELECT aircraft, day, {_S[1].replace('CAST(100.0 AS DOUBLE))', 'CAST(100.0 AS DOUBLE) + CAST(0.3 AS DOUBLE))')} AS straight, {_S[2]} AS tone, fmod(altitude_ft % 12 * CAST(45.0 AS DOUBLE), 180.0) + k % 4 AS ang, k * 3.0 AS shift, speed_mph * CAST(0.44704 AS DOUBLE) * 2 AS far FROM obs), a AS (SELECT *, ang <= 5 OR ang >= 175 AS across, abs(ang - 90) <= 5 AS up, far > 0 AND NOT shift / nullif(far, 0) BETWEEN 1 - CAST(0.35 AS DOUBLE) AND 1 + CAST(0.35 AS DOUBLE) AS locked FROM e), s AS (SELECT *, (across OR up) AND locked AS fits FROM a), t AS (SELECT *, fits AND straight >= 0.85 AND tone >= 0.2 AS seam FROM s) SELECT aircraft, day, count(*) FILTER (seam) AS seams, round(max(CASE WHEN fits THEN straight * tone ELSE 0 END), 6) AS confidence, bool_or(seam AND across) AND bool_or(seam AND up) AS is_box FROM t GROUP BY 1, 2",
    "boundary_features": f"WITH {OBS}, p AS (SELECT *, sqrt((lon - lag(lon) OVER w) * (lon - lag(lon) OVER w) + (lat - lag(lat) OVER w) * (lat - lag(lat) OVER w)) AS step FROM obs WINDOW w AS (PARTITION BY aircraft, day ORDER BY ts, obs_id)), g AS (SELECT aircraft, day, coalesce(sum(step), 0) AS len, count(*) - 1 AS segments, stddev_pop(altitude_ft) AS sd, count(DISTINCT kind) AS classes, sqrt(pow(last(lon ORDER BY ts, obs_id) - first(lon ORDER BY ts, obs_id), 2) + pow(last(lat ORDER BY ts, obs_id) - first(lat ORDER BY ts, obs_id), 2)) AS chord, coalesce(avg(value) FILTER (k % 2 = 0), 0) AS l, coalesce(avg(value) FILTER (k % 2 = 1), 0) AS r, coalesce(stddev_pop(value) FILTER (k % 2 = 0), 0) AS ls, coalesce(stddev_pop(value) FILTER (k % 2 = 1), 0) AS rs FROM p GROUP BY 1, 2), h AS (SELECT *, CASE WHEN len = 0 THEN 0 ELSE least(1.0, chord / len) END AS st, sqrt((ls * ls + rs * rs) / 2) AS pool FROM g) SELECT aircraft, day, segments, round(len, 5) AS length, round(st, 5) AS straightness, round(CASE WHEN pool <= 0 THEN least(1.0, abs(l - r)) ELSE least(1.0, abs(l - r) / (pool * 3)) END, 5) AS radiometric_delta, round(least(1.0, CAST(0.65 AS DOUBLE) * least(1.0, sd / 5000) + CAST(0.35 AS DOUBLE) * st) * CAST(0.75 AS DOUBLE) + CAST(1e-9 AS DOUBLE), 5) AS terrain_crossing, round(CAST(0.55 AS DOUBLE) * least(1.0, (classes - 1) / 4.0) + CAST(0.45 AS DOUBLE) * st, 5) AS landcover_persistence FROM h",
    "gis_overlay": f"WITH {OBS}, a AS (SELECT obs_id, kind, least(1.0, CAST(0.3 AS DOUBLE) * CASE WHEN obs_id % 3 = 0 THEN 1 ELSE {_S[0]} END + CAST(0.25 AS DOUBLE) * {_S[1]} + CAST(0.25 AS DOUBLE) * CASE WHEN obs_id % 3 = 0 THEN {_S[6]} ELSE {_S[2]} END + CAST(0.2 AS DOUBLE) * {_S[3]}) AS x FROM obs) SELECT obs_id, round(x, 6) AS alignment, CASE WHEN x >= 0.65 AND kind = 'view' THEN 'infrastructure_explains_boundary' ELSE '' END AS flags, CASE WHEN x >= 0.65 AND kind = 'view' THEN 'needs_review' ELSE 'kept' END AS review_state FROM a",
    "label_promotion": f"WITH {_PROMO} SELECT obs_id, resolved, resolution, round(adjusted, 4) AS adjusted, decision FROM q",
    "calibration_summary": f"WITH {_PROMO}, u AS (SELECT 'decision' AS histogram, decision AS bucket, * FROM q UNION ALL SELECT 'class', kind, * FROM q UNION ALL SELECT 'resolution', resolution, * FROM q) SELECT histogram, bucket, count(*) AS n, round(avg(confidence), 4) AS mean_raw, round(min(adjusted), 4) AS least, round(max(adjusted), 4) AS most, count(DISTINCT day) AS frames FROM u GROUP BY 1, 2",
    "layer_readiness": f"WITH {OBS}, s AS (SELECT aircraft, day, obs_id % 5 AS layer, arg_max({_STATE}, obs_id) AS status FROM obs GROUP BY 1, 2, 3), w AS (SELECT aircraft, day, {', '.join(_L)} FROM s GROUP BY 1, 2) SELECT aircraft, day, CASE WHEN l1 IN ('DEGRADED', 'MISSING') OR l2 IN ('DEGRADED', 'MISSING') OR l3 IN ('DEGRADED', 'MISSING') THEN 'DEGRADED' WHEN l4 IN ('DEGRADED', 'MISSING') OR l5 IN ('DEGRADED', 'MISSING') THEN 'PARTIAL' WHEN l1 || l2 || l3 || l4 || l5 = repeat('READY', 5) THEN 'READY_FOR_BATCH_ANALYSIS' ELSE 'PARTIAL' END AS status, concat_ws(',', CASE WHEN l1 <> 'READY' THEN 'L1' END, CASE WHEN l2 <> 'READY' THEN 'L2' END, CASE WHEN l3 <> 'READY' THEN 'L3' END) AS blocking, concat_ws(',', CASE WHEN l4 <> 'READY' THEN 'L4' END, CASE WHEN l5 <> 'READY' THEN 'L5' END) AS advised FROM w",
    "registry_audit": f"""WITH {OBS}, l AS (SELECT DISTINCT unnest(['N' || CAST(s_suppkey * 7 AS VARCHAR), upper(n_name)]) AS token FROM supplier JOIN nation ON s_nationkey = n_nationkey),
 w AS (SELECT 'N' || CAST(c_custkey AS VARCHAR) AS tail, CASE WHEN c_acctbal < 2000 THEN n_name ELSE c_mktsegment END AS operator FROM customer JOIN nation ON c_nationkey = n_nationkey),
 s AS (SELECT upper(aircraft) AS tail, count(*) AS sightings, count(*) FILTER (kind = 'error') AS gap_hits, max(kind) AS kind FROM obs GROUP BY 1), h AS (SELECT s.*, upper(concat_ws(' ', s.tail, operator, kind)) AS hay FROM s LEFT JOIN w ON w.tail = s.tail)
 SELECT tail, sightings, gap_hits, EXISTS (SELECT 1 FROM l WHERE contains(hay, token)) AS covered, sightings >= 3 AND NOT EXISTS (SELECT 1 FROM l WHERE token = tail) AS onboard FROM h""",
    "review_harvest": f"WITH {OBS} SELECT obs_id, CASE WHEN obs_id % 6 IN (0, 5) THEN '0' ELSE '1' END AS is_false_positive, kind AS false_positive_class, k AS confidence FROM obs WHERE obs_id % 6 IN (0, 1, 2, 5) AND k % 10 <> 0",
    "ocr_benchmark": f"WITH {OBS}, g AS (SELECT kind AS zone, CASE k % 3 WHEN 0 THEN 'baseline' WHEN 1 THEN 'sharp' ELSE 'upscaled' END AS variant, count(*) AS n, round(avg(confidence), 4) AS conf, round(avg(altitude_ft % 40), 4) AS words, avg(obs_id % 7) AS h, round(avg(value), 4) AS seconds FROM obs GROUP BY 1, 2) SELECT g.zone, g.variant, g.n, g.conf, g.words, round(g.h, 4) AS hits, g.seconds, CASE WHEN g.variant <> 'baseline' THEN round(g.h - b.h, 4) END AS delta FROM g LEFT JOIN g b ON b.zone = g.zone AND b.variant = 'baseline'",
    "best_assessments": f"WITH {OBS} SELECT aircraft, day, obs_id, CASE kind WHEN 'view' THEN 'TILE_SEAM' ELSE 'SHADOW' END AS artifact, least(CAST(0.74 AS DOUBLE), confidence) AS score, count(*) OVER (PARTITION BY aircraft, day) AS candidates FROM obs WHERE kind IN ('view', 'error') QUALIFY row_number() OVER (PARTITION BY aircraft, day ORDER BY confidence DESC, obs_id) = 1",
    "legacy_status": f"WITH {OBS}, n AS (SELECT corridor_id, kind, count(*) FILTER (confidence >= 0.9) AS c, count(*) FILTER (k < 5) AS f FROM obs GROUP BY 1, 2) SELECT corridor_id, CAST(sum(c) AS BIGINT) AS candidates, count(*) FILTER (f > 20) AS flagged_layers, CASE WHEN max(f) > 20 THEN 'needs_calibration' ELSE 'calibrated' END AS status FROM n GROUP BY 1",
    "infrastructure_steps": f"WITH {OBS}, {AIR}, m AS (SELECT obs_id, altitude_ft, min({hav_sql('lat', 'lon', 'a_lat', 'a_lon', 3440.065)}) AS d FROM obs, air GROUP BY 1, 2) SELECT obs_id, CAST(CASE WHEN d <= 2 THEN 1 WHEN d <= 5 THEN 0.75 WHEN d <= 10 THEN 0.5 WHEN d <= 20 THEN 0.25 ELSE 0.1 END AS DOUBLE) AS infrastructure, CAST(CASE WHEN altitude_ft < 200 THEN 0.9 WHEN altitude_ft < 800 THEN 0.6 WHEN altitude_ft < 4000 THEN 0.4 ELSE 0.2 END AS DOUBLE) AS hydro FROM m",
    "field_choices": f"""WITH {OBS}, f AS (SELECT obs_id, confidence < 0.5 AS rsure, CASE WHEN obs_id % 2 = 0 THEN 'right_panel' ELSE 'bottom_timeline' END AS rg, CASE WHEN k % 3 = 0 THEN '' ELSE aircraft END AS cw, CASE WHEN k % 4 = 0 THEN '' WHEN k % 5 = 0 THEN 'OTHER' ELSE lower(aircraft) END AS cr, CASE WHEN k % 2 = 0 THEN '' ELSE CAST(altitude_ft AS VARCHAR) END AS aw, CASE WHEN k % 5 = 0 THEN '' ELSE CAST(altitude_ft AS VARCHAR) END AS ar FROM obs),
 s AS (SELECT *, CASE WHEN cw <> '' AND cr <> '' AND lower(cw) <> lower(cr) THEN 'disagreement' WHEN cw = '' AND cr = '' THEN 'missing' WHEN cr = '' OR (cw <> '' AND NOT rsure) THEN 'whole_image' ELSE 'region:' || rg END AS cs, CASE WHEN aw = '' AND ar = '' THEN 'missing' WHEN ar = '' OR (aw <> '' AND NOT rsure AND rg <> 'right_panel') THEN 'whole_image' ELSE 'region:' || rg END AS s2 FROM f)
 SELECT obs_id, CASE WHEN cs = 'whole_image' THEN cw WHEN starts_with(cs, 'region') THEN cr ELSE '' END AS callsign, CASE WHEN s2 = 'whole_image' THEN aw WHEN starts_with(s2, 'region') THEN ar ELSE '' END AS altitude, CASE WHEN cs = 'disagreement' THEN 'callsign' ELSE '' END AS disagreements, concat_ws(';', CASE WHEN cs = 'missing' THEN 'callsign' END, CASE WHEN s2 = 'missing' THEN 'altitude' END) AS missing, array_to_string(list_sort(list_distinct(list_filter([cs, s2], lambda x: x NOT IN ('missing', 'disagreement')))), ';') AS sources FROM s""",
    "review_priorities": f"WITH {OBS}, p AS (SELECT obs_id, corridor_id, round(CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 10 ELSE 20 END + CASE kind WHEN 'error' THEN 20 WHEN 'view' THEN 5 ELSE 0 END + confidence * 5, 2) AS priority FROM obs) SELECT *, CAST(row_number() OVER (PARTITION BY corridor_id ORDER BY priority DESC, obs_id) AS INT) AS rank FROM p",
    "heading_shapes": f"WITH {OBS}, o AS (SELECT aircraft, day, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 37 = 0 THEN 0 ELSE speed_mph + 1 END AS v, CASE WHEN k % 3 > 0 THEN altitude_ft % 360 END AS h FROM obs), g AS (SELECT aircraft, day, coalesce(bool_or(v = 0), false) AS hover, coalesce(bool_or(v > 0 AND h IS NOT NULL), false) AS moves FROM o GROUP BY 1, 2), m AS (SELECT DISTINCT a.aircraft, a.day FROM o a JOIN o b USING (aircraft, day) WHERE least(abs(a.h - b.h), 360 - abs(a.h - b.h)) >= 60) SELECT aircraft, day, CASE WHEN hover THEN 'hover' WHEN (aircraft, day) IN (SELECT (aircraft, day) FROM m) THEN 'multi' WHEN moves THEN 'linear' ELSE 'absent' END AS shape FROM g",
    "artifact_families": f"WITH {OBS}, n AS (SELECT obs_id, {_NOTES} AS note, CASE obs_id % 4 WHEN 0 THEN 'KEPT' WHEN 1 THEN 'STRUCTURAL_SIGNAL' ELSE '' END AS a, CASE WHEN obs_id % 5 = 0 THEN 'set' ELSE '' END AS r FROM obs) SELECT obs_id, CASE WHEN a = 'KEPT' THEN a {' '.join(f'''WHEN regexp_matches({_HAY}, '{w}') THEN '{k}' ''' for k, _, w in _WORDS)} ELSE 'HOLD_REVIEW' END AS artifact_class, CASE WHEN r <> '' THEN r {' '.join(f'''WHEN regexp_matches({_HAY}, '{w}') THEN '{x}' ''' for _, x, w in _WORDS)} ELSE 'low' END AS artifact_risk FROM n",
}
