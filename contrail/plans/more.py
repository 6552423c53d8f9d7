"""Queries: enrichment and quality joins, samples, audits and orderings that round off the other families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import joins as J
from ..operators import ladders as L
from .mapping import AIR, OBS, airports, hav_sql, observations, table


def flights_with_aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight with its aircraft's master row, where there is one; a number without N gets it first."""
    o = observations(spark, sf_dir).groupBy("aircraft", "day").agg(F.count("*").alias("points"))
    tail = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.concat(F.lit("n"), F.col("c_custkey").cast("string")))
    m = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(tail.alias("raw"), F.col("c_mktsegment").alias("model"))
    whole = F.when(F.upper("raw").startswith("N"), F.upper("raw")).otherwise(F.concat(F.lit("N"), F.upper("raw")))
    return o.join(m.select(whole.alias("aircraft"), "model"), "aircraft", "left")


def queued_screenshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review items with their screenshot and how often it is asked for; items whose screenshot is gone stay."""
    items = table(spark, sf_dir, "labels").select("doc_id", "quality")
    shots = table(spark, sf_dir, "documents").where("doc_id % 5 > 0").select("doc_id", "source", "n_chars")
    return items.join(shots, "doc_id", "left").groupBy("source", "quality").agg(F.count("*").alias("items"), F.sum("n_chars").alias("chars"))


def infrastructure_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points within each place's own radius: how many places are near, and the nearest."""
    o = observations(spark, sf_dir).where("kind = 'view'").select("obs_id", "lat", "lon")
    a = airports(spark, sf_dir).withColumn("radius_km", F.lit(2.0) + F.col("airport_id") % 7 * 2.0)
    met = J.radius_join(o, a, 14.0, ("lat", "lon"), ("a_lat", "a_lon")).where("distance_km <= radius_km")
    return met.groupBy("obs_id").agg(F.count("*").alias("places"), F.round(F.min("distance_km"), 5).alias("nearest_km"))


def layer_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layers whose box holds a point, and the distance to the nearest layer's middle, inside or not."""
    o = observations(spark, sf_dir).where("kind = 'signup'").select("obs_id", "lat", "lon")
    a = airports(spark, sf_dir)
    boxes = a.select("airport", (F.col("a_lat") - 0.15).alias("s"), (F.col("a_lon") - 0.15).alias("w"), (F.col("a_lat") + 0.15).alias("n"), (F.col("a_lon") + 0.15).alias("e"))
    held = J.box_join(o, boxes, ("lat", "lon"), ("s", "w", "n", "e"), 0.3).groupBy("obs_id").agg(F.count("*").alias("n_layers"), F.min("airport").alias("first_layer"))
    near = J.nearest(o, a, "obs_id", ("lat", "lon"), ("a_lat", "a_lon"), [F.col("airport_id")]).select("obs_id", F.round("distance_km", 5).alias("nearest_km"))
    return near.join(held, "obs_id", "left").na.fill(0, ["n_layers"])


def raw_text_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tails that stand as whole words in raw texts, but for those that the text's row has already."""
    o = observations(spark, sf_dir).select("obs_id", F.concat(F.lit("seen "), F.col("aircraft"), F.lit(", N"), (F.col("k") * 3).cast("string"), F.when(F.col("k") % 2 == 0, "").otherwise("X"), F.lit(". N"), (F.col("obs_id") % 170).cast("string")).alias("raw"), "aircraft")
    tails = o.select(F.col("aircraft").alias("tail")).distinct()
    words = o.select("obs_id", "aircraft", F.explode(F.array_distinct(F.regexp_extract_all("raw", F.lit(r"\bN\d+[A-Z]*\b"), F.lit(0)))).alias("tail"))
    return words.join(tails, "tail").where("tail <> aircraft").select("obs_id", "tail")


def feature_meanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature names and how many features each may mean."""
    p = table(spark, sf_dir, "part")
    keys = p.select("p_partkey", F.explode(F.array(text.fold(F.col("p_name")), text.fold(F.col("p_type")))).alias("key"))
    return keys.groupBy("key").agg(F.countDistinct("p_partkey").alias("meanings"), F.min("p_partkey").alias("first_id")).withColumn("status", F.when(F.col("meanings") > 1, "ambiguous").otherwise("unique"))


def fuzzy_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions against truths, exact and within a fifth of the longer text's letters."""
    p = table(spark, sf_dir, "part").select("p_type", "p_brand", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_type"), F.lit("X"))).when(F.col("p_partkey") % 3 == 1, F.col("p_type")).otherwise(F.col("p_name")).alias("guess"))
    close = F.levenshtein("p_type", "guess") <= 0.2 * F.greatest(F.length("p_type"), F.length("guess"))
    return p.groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("p_type") == F.col("guess")).alias("exact"), F.count_if(close).alias("fuzzy"))


def density_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the heat map by band, with the least, mean and largest weight."""
    o = observations(spark, sf_dir).where("kind = 'view'")
    g = o.groupBy(F.rint(F.col("lat") / F.lit(0.05)).cast("int").alias("y"), F.rint(F.col("lon") / F.lit(0.05)).cast("int").alias("x")).agg(F.count("*").alias("w"))
    level = F.least(F.lit(1.0), F.col("w") / 10.0)
    return g.groupBy(F.when(level >= 0.75, "red").when(level >= 0.5, "orange").when(level >= 0.25, "yellow").otherwise("blue").alias("band")).agg(F.count("*").alias("cells"), F.min("w").alias("least"), F.round(F.avg("w"), 5).alias("mean"), F.max("w").alias("most"))


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities by sightings, those without any among them, with their busiest aircraft."""
    o = observations(spark, sf_dir).withColumn("m", F.col("altitude_ft") % 40)
    n = o.groupBy("m", "aircraft").agg(F.count("*").alias("c")).groupBy("m").agg(F.sum("c").alias("sightings"), F.count("*").alias("aircraft"), F.max(F.struct("c", F.lit("x").alias("z"))).alias("t"))
    every = table(spark, sf_dir, "nation").select((F.col("n_nationkey").cast("long") * 2).alias("m"), F.col("n_name").alias("municipality"))
    return every.join(n, "m", "left").select("municipality", F.coalesce("sightings", F.lit(0)).alias("sightings"), F.coalesce("aircraft", F.lit(0)).alias("aircraft"), F.coalesce("t.c", F.lit(0)).alias("busiest"), F.col("sightings").isNull().alias("gap"))


def affine_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lines fitted to each frame's points, their median residual, how far the axes' scales differ, and the verdict."""
    o = observations(spark, sf_dir).select("aircraft", F.col("k").cast("double").alias("px"), (F.col("altitude_ft") / 100.0).alias("py"), (F.col("k") * 0.01 + (F.col("obs_id") % 7) * 0.01).alias("gx"), (F.col("altitude_ft") * 0.00012 + (F.col("obs_id") % 5) * 0.01).alias("gy"))
    fit = o.groupBy("aircraft").agg(F.count("*").alias("n"), *[f(g, p).alias(m + g) for g, p in (("gx", "px"), ("gy", "py")) for m, f in (("a", F.regr_intercept), ("b", F.regr_slope))])
    met = o.join(fit, "aircraft")
    away = F.hypot(F.col("gx") - F.col("agx") - F.col("bgx") * F.col("px"), F.col("gy") - F.col("agy") - F.col("bgy") * F.col("py"))
    r = met.groupBy("aircraft").agg(F.max("n").alias("n"), F.median(away).alias("residual"), F.max("bgx").alias("sx"), F.max("bgy").alias("sy"))
    differ = F.abs(F.col("sx") - F.col("sy")) / F.greatest(F.abs("sx"), F.abs("sy"), F.lit(1e-12))
    verdict = F.when(F.col("n") < 30, "too_few").when(F.col("differ") > 0.19, "axes_disagree").when(F.col("residual") > 0.02, "residual").otherwise("accepted")
    return r.withColumn("differ", differ).select("aircraft", F.round("residual", 5).alias("residual"), F.round("differ", 5).alias("differ"), verdict.alias("verdict"))


def wave_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the dashboard by day."""
    o = observations(spark, sf_dir)
    return o.groupBy("day").agg(F.countDistinct("aircraft").alias("waves"), F.count_if(F.col("kind") == "error").alias("held"), F.count_if(F.col("confidence") >= 0.8).alias("ready"), F.count_if((F.col("confidence") < 0.2) & (F.col("kind") == "view")).alias("review"))


def orientation_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three child tables by orientation, an orientation that a table lacks counting none."""
    o = observations(spark, sf_dir).withColumn("orientation", F.when(F.col("k") < 30, "portrait").when(F.col("k") < 32, "square").otherwise("landscape"))
    one = lambda kind, name, where="true": o.where(F.col("kind") == kind).where(where).groupBy("orientation").agg(F.count("*").alias(name))
    met = one("view", "ocr").join(one("click", "pins", "k < 31"), "orientation", "full").join(one("error", "icons"), "orientation", "full")
    return met.na.fill(0, ["ocr", "pins", "icons"])


def annotation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations by zone: how many are right and their share, and at each threshold how many routes are kept."""
    o = observations(spark, sf_dir)
    sweep = F.explode(F.sequence(F.lit(20), F.lit(80), F.lit(20))).alias("threshold")
    return o.select("kind", "k", "obs_id", sweep).groupBy("kind", "threshold").agg(F.count("*").alias("n"), F.count_if(F.col("k") >= F.col("threshold")).alias("kept"), F.round(F.avg(F.when(F.col("k") >= F.col("threshold"), (F.col("obs_id") % 3 == 0).cast("double"))), 5).alias("right_share"))


def probe_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty files: fifteen of one kind and thirty of another at most, then others, filled up from the rest, none twice."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 10 < 2, "heic").when(F.col("doc_id") % 10 < 9, "png").otherwise("other").alias("ext"))
    r = d.withColumn("r", F.row_number().over(Window.partitionBy("ext").orderBy("doc_id")))
    first = F.when((F.col("ext") == "heic") & (F.col("r") <= 15), 1).when((F.col("ext") == "png") & (F.col("r") <= 30), 2).when(F.col("ext") == "other", 3).otherwise(4)
    return r.withColumn("step", first).orderBy("step", "doc_id").limit(50).select("doc_id", "ext", "step")


def severity_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severities and orientations by their rules, counted."""
    o = observations(spark, sf_dir)
    severity = F.when((F.col("kind") == "error") & (F.col("k") > 80), "critical").when(F.col("kind") == "error", "high").when(F.col("confidence") < 0.3, "medium").otherwise("low")
    facing = F.when(F.col("speed_mph") > F.col("k") * 2, "landscape").when(F.col("speed_mph") == F.col("k") * 2, "square").otherwise("portrait")
    return o.groupBy(severity.alias("severity"), facing.alias("orientation")).agg(F.count("*").alias("n"))


def falsy_sorted(spark: SparkSession, sf_dir: str, limit: int = 40) -> DataFrame:
    """A page sorted by a column as text, downwards, with none, nought and false as empty; a limit below nought is nought."""
    o = observations(spark, sf_dir).select("obs_id", F.when(F.col("k") % 4 == 0, 0).when(F.col("k") % 4 == 1, F.lit(None)).otherwise(F.col("k")).alias("v"))
    key = F.when(F.col("v").isNull() | (F.col("v") == 0), "").otherwise(F.col("v").cast("string"))
    return o.withColumn("key", key).orderBy(F.desc("key"), "obs_id").limit(max(0, limit)).select("obs_id", "key")


def poi_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of each day's sequence of places: single, stationary, loop, hub and spoke, a line, or several visits."""
    o = observations(spark, sf_dir)
    # the places of one aircraft on one day
    q = F.transform(F.array_sort(F.collect_list(F.struct("ts", "obs_id", "kind"))), lambda x: x["kind"])
    g = o.groupBy("aircraft", "day").agg(q.alias("q"))
    n, kinds = F.size("q"), F.array_distinct("q")
    most = F.array_max(F.transform(kinds, lambda u: F.size(F.filter("q", lambda x: x == u))))
    shape = F.when(n == 1, "single_poi").when(F.size(kinds) == 1, "stationary").when((F.element_at("q", 1) == F.element_at("q", -1)) & (n >= 3), "loop").when(most / n > 0.5, "hub_and_spoke").when(F.size(kinds) == n, "linear").otherwise("multi_visit")
    return g.select("aircraft", "day", shape.alias("shape"))


def label_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak classes of unknown labels and of components by their geometry."""
    o = observations(spark, sf_dir)
    label = F.when(F.col("k") % 5 == 0, "HGR 12").when(F.col("k") % 5 == 1, "Rio Grande").when(F.col("k") % 5 == 2, F.col("aircraft")).when(F.col("k") % 5 == 3, "12:45").otherwise("xx")
    w, h = F.col("k") + 1, F.col("altitude_ft") % 90 + 1
    s = o.select("obs_id", label.alias("label"), w.alias("w"), h.alias("h"))
    kind = F.when(F.col("label").rlike(r"^N\d+"), "tail").when(F.col("label").rlike(r"^\d{1,2}:\d{2}$"), "time").when(F.lower("label").rlike("hgr|hangar"), "facility").when(F.length("label") < 4, "noise").otherwise("place")
    ratio = F.greatest("w", "h") / F.least("w", "h")
    form = F.when(F.col("w") * F.col("h") < 64, "dot").when(ratio >= 6, "line").when(ratio <= 1.25, "square").otherwise("block")
    return s.groupBy(kind.alias("label_class"), form.alias("component")).agg(F.count("*").alias("n"))


def footprint_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints from rows of text: slug, code, coordinates, kind, operator's class and radius."""
    s = table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("Aeropuerto  "), F.col("s_name"), F.when(F.col("s_suppkey") % 3 == 0, " (TJ").otherwise(" [TX"), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 3 == 0, ")").otherwise("]"))
    where = F.when(F.col("s_suppkey") % 4 == 0, "n/a").otherwise(F.concat(F.lit("18."), F.lpad(F.col("s_suppkey").cast("string"), 3, "0"), F.lit(" , -66.5")))
    r = s.select("s_suppkey", name.alias("name"), where.alias("at"), "s_acctbal")
    slug = F.trim(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), F.lit("-"))
    code = F.nullif(F.regexp_extract("name", r"\(([A-Z]{2}\d+)\)", 1), F.lit(""))
    point = lambda g: F.nullif(F.regexp_extract("at", r"^(-?\d+\.\d+)\s*,\s*(-?\d+\.\d+)$", g), F.lit("")).try_cast("double")
    kind = F.when(F.col("s_acctbal") > 6000, "airport").when(F.col("s_acctbal") > 2000, "heliport").otherwise("pad")
    return r.select("s_suppkey", slug.alias("slug"), code.alias("code"), point(1).alias("lat"), point(2).alias("lon"), kind.alias("kind"), F.when(F.col("s_acctbal") < 0, "private").otherwise("public").alias("operator_class"), F.when(F.col("s_acctbal") > 6000, 5.0).when(F.col("s_acctbal") > 2000, 1.5).otherwise(0.5).alias("radius_nm"))


def changed_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the pixels (components) of following pictures that differ by more than a limit; sizes that differ give none."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    met = e.join(after, "vec_id")
    apart = F.zip_with("embedding", "other", lambda a, b: F.abs(a.cast("double") - b.cast("double")) > 0.1)
    share = F.size(F.filter(apart, lambda x: x)) / F.size("embedding")
    return met.select("vec_id", F.round(F.when(F.size("embedding") == F.size("other"), share), 6).alias("changed"))


def _scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales of views, by profile; near copies are one piece of evidence."""
    o = observations(spark, sf_dir)
    scale = F.pow(F.lit(2.0), F.col("k") % 5 - 2) * (1.0 + (F.col("obs_id") % 23 - 11) / 100.0) * (F.lit(3.0) + F.col("corridor_id").cast("int"))
    evidence = F.when(F.col("k") % 3 > 0, F.concat(F.lit("near_dup:"), F.col("k") * 7 + F.col("obs_id") % 5)).otherwise(F.concat(F.lit("screenshot:"), "obs_id"))
    return o.select("obs_id", F.col("corridor_id").alias("profile"), scale.alias("scale"), evidence.alias("evidence"), (scale * 1e-5).alias("dlon_dx"), (-scale * (1.0 + F.col("k") / 1000.0) * 1e-5).alias("dlat_dy"))


def zoom_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zoom levels of each profile: whole steps from its densest cluster of scales, by independent evidence."""
    r = L.rungs(L.stepped(_scales(spark, sf_dir)), ["dlon_dx", "dlat_dy"])
    return r.select("profile", "rung", F.round("scale", 6).alias("scale"), F.round("dlon_dx", 9).alias("dlon_dx"), F.round("dlat_dy", 9).alias("dlat_dy"), "support", F.round("dispersion", 6).alias("dispersion"), "records", "eligible")


QUERIES = {
    f.__name__: f
    for f in (
        flights_with_aircraft, queued_screenshots, infrastructure_proximity, layer_distances, raw_text_tails, feature_meanings, fuzzy_accuracy, density_statistics, coverage_gaps, affine_quality, wave_dashboard,
        orientation_breakdown, annotation_scores, probe_sample, severity_cases, falsy_sorted, poi_shapes, label_classes, footprint_import, changed_fractions, zoom_rungs,
    )
}

_KM = hav_sql("lat", "lon", "a_lat", "a_lon", 6371.0088)
_D = "CAST({} AS DOUBLE)".format
ORACLE = {
    "flights_with_aircraft": f"WITH {OBS}, f AS (SELECT aircraft, day, count(*) AS points FROM obs GROUP BY 1, 2) SELECT aircraft, day, points, c_mktsegment AS model FROM f LEFT JOIN customer ON 'N' || c_custkey = aircraft AND c_acctbal > 0",
    "queued_screenshots": "SELECT source, quality, count(*) AS items, CAST(sum(n_chars) AS BIGINT) AS chars FROM labels LEFT JOIN (SELECT * FROM documents WHERE doc_id % 5 > 0) USING (doc_id) GROUP BY 1, 2",
    "infrastructure_proximity": f"WITH {OBS}, {AIR}, m AS (SELECT obs_id, {_KM} AS d, 2 + airport_id % 7 * 2 AS r FROM obs, air WHERE kind = 'view') SELECT obs_id, count(*) AS places, round(min(d), 5) AS nearest_km FROM m WHERE d <= r GROUP BY 1",
    "layer_distances": f"WITH {OBS}, {AIR} SELECT obs_id, round(min({_KM}), 5) AS nearest_km, count(*) FILTER (i) AS n_layers, min(airport) FILTER (i) AS first_layer FROM (SELECT *, lat BETWEEN a_lat - {_D(0.15)} AND a_lat + {_D(0.15)} AND lon BETWEEN a_lon - {_D(0.15)} AND a_lon + {_D(0.15)} AS i FROM obs, air WHERE kind = 'signup') GROUP BY 1",
    "raw_text_tails": f"WITH {OBS}, w AS (SELECT DISTINCT obs_id, aircraft, unnest(['N' || (k * 3) || CASE WHEN k % 2 = 0 THEN '' ELSE 'X' END, 'N' || (obs_id % 170)]) AS tail FROM obs) SELECT obs_id, tail FROM w WHERE tail <> aircraft AND tail IN (SELECT aircraft FROM obs)",
    "feature_meanings": "WITH k AS (SELECT p_partkey, unnest([p_name, p_type]) AS t FROM part), f AS (SELECT p_partkey, trim(regexp_replace(upper(t), '[^A-Z0-9]+', ' ', 'g')) AS key FROM k) SELECT key, count(DISTINCT p_partkey) AS meanings, min(p_partkey) AS first_id, CASE WHEN count(DISTINCT p_partkey) > 1 THEN 'ambiguous' ELSE 'unique' END AS status FROM f GROUP BY 1",
    "fuzzy_accuracy": "WITH g AS (SELECT p_type, p_brand, CASE p_partkey % 3 WHEN 0 THEN p_type || 'X' WHEN 1 THEN p_type ELSE p_name END AS guess FROM part) SELECT p_brand, count(*) AS n, count(*) FILTER (p_type = guess) AS exact, count(*) FILTER (levenshtein(p_type, guess) * 5 <= greatest(length(p_type), length(guess))) AS fuzzy FROM g GROUP BY 1",
    "density_statistics": f"WITH {OBS}, g AS (SELECT round_even(lat / {_D(0.05)}, 0) AS y, round_even(lon / {_D(0.05)}, 0) AS x, count(*) AS w FROM obs WHERE kind = 'view' GROUP BY 1, 2) SELECT CASE WHEN w >= 7.5 THEN 'red' WHEN w >= 5 THEN 'orange' WHEN w >= 2.5 THEN 'yellow' ELSE 'blue' END AS band, count(*) AS cells, min(w) AS least, round(avg(w), 5) AS mean, max(w) AS most FROM g GROUP BY 1",
    "coverage_gaps": f"WITH {OBS}, n AS (SELECT altitude_ft % 40 AS m, aircraft, count(*) AS c FROM obs GROUP BY 1, 2), s AS (SELECT m, CAST(sum(c) AS BIGINT) AS sightings, count(*) AS aircraft, max(c) AS busiest FROM n GROUP BY 1) SELECT n_name AS municipality, coalesce(sightings, 0) AS sightings, coalesce(aircraft, 0) AS aircraft, coalesce(busiest, 0) AS busiest, sightings IS NULL AS gap FROM nation LEFT JOIN s ON m = n_nationkey * 2",
    "affine_quality": f"WITH {OBS}, o AS (SELECT aircraft, CAST(k AS DOUBLE) AS px, altitude_ft / {_D(100)} AS py, k * {_D(0.01)} + (obs_id % 7) * {_D(0.01)} AS gx, altitude_ft * {_D(0.00012)} + (obs_id % 5) * {_D(0.01)} AS gy FROM obs), f AS (SELECT aircraft, count(*) AS n, regr_intercept(gx, px) AS ax, regr_slope(gx, px) AS bx, regr_intercept(gy, py) AS ay, regr_slope(gy, py) AS b2 FROM o GROUP BY 1), r AS (SELECT aircraft, max(n) AS n, median(sqrt(pow(gx - ax - bx * px, 2) + pow(gy - ay - b2 * py, 2))) AS res, max(abs(bx - b2) / greatest(abs(bx), abs(b2), 1e-12)) AS dif FROM o JOIN f USING (aircraft) GROUP BY 1) SELECT aircraft, round(res, 5) AS residual, round(dif, 5) AS differ, CASE WHEN n < 30 THEN 'too_few' WHEN dif > 0.19 THEN 'axes_disagree' WHEN res > 0.02 THEN 'residual' ELSE 'accepted' END AS verdict FROM r",
    "wave_dashboard": f"WITH {OBS} SELECT day, count(DISTINCT aircraft) AS waves, count(*) FILTER (kind = 'error') AS held, count(*) FILTER (confidence >= 0.8) AS ready, count(*) FILTER (confidence < 0.2 AND kind = 'view') AS review FROM obs GROUP BY 1",
    "orientation_breakdown": f"WITH {OBS}, o AS (SELECT *, CASE WHEN k < 30 THEN 'portrait' WHEN k < 32 THEN 'square' ELSE 'landscape' END AS orientation FROM obs) SELECT orientation, count(*) FILTER (kind = 'view') AS ocr, count(*) FILTER (kind = 'click' AND k < 31) AS pins, count(*) FILTER (kind = 'error') AS icons FROM o GROUP BY 1",
    "annotation_scores": f"WITH {OBS}, s AS (SELECT kind, k, obs_id, unnest([20, 40, 60, 80]) AS threshold FROM obs) SELECT kind, threshold, count(*) AS n, count(*) FILTER (k >= threshold) AS kept, round(avg(CASE WHEN obs_id % 3 = 0 THEN 1.0 ELSE 0 END) FILTER (k >= threshold), 5) AS right_share FROM s GROUP BY 1, 2",
    "probe_sample": "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 10 < 2 THEN 'heic' WHEN doc_id % 10 < 9 THEN 'png' ELSE 'other' END AS ext FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY ext ORDER BY doc_id) AS r FROM d) SELECT doc_id, ext, CASE WHEN ext = 'heic' AND r <= 15 THEN 1 WHEN ext = 'png' AND r <= 30 THEN 2 WHEN ext = 'other' THEN 3 ELSE 4 END AS step FROM r ORDER BY step, doc_id LIMIT 50",
    "severity_cases": f"WITH {OBS} SELECT CASE WHEN kind = 'error' AND k > 80 THEN 'critical' WHEN kind = 'error' THEN 'high' WHEN confidence < 0.3 THEN 'medium' ELSE 'low' END AS severity, CASE WHEN speed_mph > k * 2 THEN 'landscape' WHEN speed_mph = k * 2 THEN 'square' ELSE 'portrait' END AS orientation, count(*) AS n FROM obs GROUP BY 1, 2",
    "falsy_sorted": f"WITH {OBS}, s AS (SELECT obs_id, CASE WHEN k % 4 < 2 THEN '' ELSE CAST(k AS VARCHAR) END AS key FROM obs) SELECT * FROM s ORDER BY key DESC, obs_id LIMIT 40",
    "poi_shapes": f"WITH {OBS}, c AS (SELECT aircraft, day, kind, count(*) AS c FROM obs GROUP BY 1, 2, 3), m AS (SELECT aircraft, day, max(c) AS most, count(*) AS kinds FROM c GROUP BY 1, 2), g AS (SELECT aircraft, day, count(*) AS n, first(kind ORDER BY ts, obs_id) AS f, last(kind ORDER BY ts, obs_id) AS l FROM obs GROUP BY 1, 2) SELECT aircraft, day, CASE WHEN n = 1 THEN 'single_poi' WHEN kinds = 1 THEN 'stationary' WHEN f = l AND n >= 3 THEN 'loop' WHEN most * 2 > n THEN 'hub_and_spoke' WHEN kinds = n THEN 'linear' ELSE 'multi_visit' END AS shape FROM g JOIN m USING (aircraft, day)",
    "label_classes": f"WITH {OBS}, s AS (SELECT k % 5 AS c, aircraft, k + 1 AS w, altitude_ft % 90 + 1 AS h FROM obs) SELECT CASE c WHEN 0 THEN 'facility' WHEN 1 THEN 'place' WHEN 2 THEN 'tail' WHEN 3 THEN 'time' ELSE 'noise' END AS label_class, CASE WHEN w * h < 64 THEN 'dot' WHEN greatest(w, h) >= 6 * least(w, h) THEN 'line' WHEN greatest(w, h) * 4 <= 5 * least(w, h) THEN 'square' ELSE 'block' END AS component, count(*) AS n FROM s GROUP BY 1, 2",
    "changed_fractions": "SELECT a.vec_id, round(len(list_filter(list_zip(a.embedding, b.embedding), lambda p: abs(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) > 0.1)) / CAST(len(a.embedding) AS DOUBLE), 6) AS changed FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "footprint_import": "SELECT s_suppkey, 'aeropuerto-' || replace(lower(s_name), '#', '-') || CASE WHEN s_suppkey % 3 = 0 THEN '-tj' ELSE '-tx' END || s_suppkey AS slug, CASE WHEN s_suppkey % 3 = 0 THEN 'TJ' || s_suppkey END AS code, CASE WHEN s_suppkey % 4 > 0 THEN CAST('18.' || lpad(CAST(s_suppkey AS VARCHAR), 3, '0') AS DOUBLE) END AS lat, CASE WHEN s_suppkey % 4 > 0 THEN CAST(-66.5 AS DOUBLE) END AS lon, CASE WHEN s_acctbal > 6000 THEN 'airport' WHEN s_acctbal > 2000 THEN 'heliport' ELSE 'pad' END AS kind, CASE WHEN s_acctbal < 0 THEN 'private' ELSE 'public' END AS operator_class, CAST(CASE WHEN s_acctbal > 6000 THEN 5 WHEN s_acctbal > 2000 THEN 1.5 ELSE 0.5 END AS DOUBLE) AS radius_nm FROM supplier",
}
