"""Queries: counts, histograms, grids, clusters, calibration and registries' rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import aggregates as A
from ..operators.cuts import row_numbers
from .mapping import OBS, observations, table


def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.agg(
        F.count("*").alias("n"), F.countDistinct("aircraft").alias("aircraft"), F.count_if(F.col("confidence") >= 0.7).alias("high"),
        F.count_if((F.col("lat") > 18.2) & (F.col("kind") == "view")).alias("located_views"), F.countDistinct("day").alias("days"),
    )


def zone_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.when(F.col("confidence") < 0.4, 1).otherwise(0)).alias("low"), F.round(F.avg(F.coalesce("confidence", F.lit(0.0))), 4).alias("mean_confidence"))


def two_key_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("kind", geo.band(F.col("confidence")).alias("severity")).agg(F.count("*").alias("n"))


def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts with one hash, numbered in the order of their first document."""
    d = table(spark, sf_dir, "documents").withColumn("sha256", F.sha2("text", 256))
    g = d.groupBy("sha256").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")
    return row_numbers(g, [F.col("first_doc")], "_i").withColumn("dup_group_id", F.col("_i") + 1).drop("_i")


def grouped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: x["p_name"]), " | ")
    return p.groupBy("p_brand", "p_size").agg(names.alias("names"))


def route_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origin-destination edges: count, mean weight, commonest callsign (first seen in a tie), confidence min(1, n / 5)."""
    o, l, s, c = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "supplier", "customer"))
    t = o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    t = t.select("c_nationkey", "s_nationkey", "l_quantity", "c_mktsegment", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seen"))
    mode = A.mode_first(t, ["c_nationkey", "s_nationkey"], "c_mktsegment", "seen").drop("n")
    e = t.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_quantity"))
    return e.join(mode, ["c_nationkey", "s_nationkey"]).withColumn("confidence", F.least(F.lit(1.0), F.col("n") / 5.0))


def grid_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    g = o.groupBy(geo.near_cell(F.col("lat"), 0.05).alias("cell_y"), geo.near_cell(F.col("lon"), 0.05).alias("cell_x")).agg(F.sum(F.lit(1.0)).alias("weight"))
    level = F.least(F.lit(1.0), F.col("weight") / 10.0)
    return g.withColumn("intensity", level).withColumn("band", F.when(level >= 0.75, "red").when(level >= 0.5, "orange").when(level >= 0.25, "yellow").otherwise("blue"))


def poi_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of 0.05 degrees with three points and two aircraft at least, their centroid and weighted score."""
    o = observations(spark, sf_dir)
    g = o.groupBy(geo.cell(F.col("lat"), 0.05).alias("cell_y"), geo.cell(F.col("lon"), 0.05).alias("cell_x")).agg(
        F.count("*").alias("points"), F.countDistinct("aircraft").alias("flights"), F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"),
        (F.count_if(F.col("speed_mph") < 60) / F.count("*")).alias("loiter"), F.countDistinct("day").alias("days"),
    ).where("points >= 3 and flights >= 2")
    score = 0.30 * F.least(F.lit(1.0), F.col("points") / 20.0) + 0.25 * F.least(F.lit(1.0), F.col("flights") / 10.0) + 0.20 * F.least(F.lit(1.0), F.col("days") / 10.0) + 0.25 * F.col("loiter")
    return g.select("cell_y", "cell_x", "points", "flights", "lat", "lon", F.round(score, 4).alias("score"))


def corridor_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft with over 30 % of their points within a corridor of 5 nm between two places."""
    o = observations(spark, sf_dir).where("kind = 'view'")
    lanes = spark.createDataFrame([(1, -67.2, 17.95, -65.3, 18.6), (2, -67.0, 18.5, -65.5, 18.0)], "lane int, ax double, ay double, bx double, by double")
    met = o.join(F.broadcast(lanes))
    d = geo.segment_nm(*[F.col(c) for c in ("lon", "lat", "ax", "ay", "bx", "by")])
    g = met.withColumn("inside", (d <= 5.0 / 2 + 1).cast("int")).groupBy("aircraft", "lane").agg(F.sum("inside").alias("inside"), F.count("*").alias("n"))
    return g.withColumn("confidence", F.round(F.col("inside") / F.col("n"), 6)).where("confidence > 0.3")


def batch_status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    p = o.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey"))
    images = o.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("images"))
    return p.join(images, "o_orderpriority").na.fill(0)


def positional_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of 16 pixels with five days at least and at most 8 % of all days' points, and their top three aircraft."""
    o = observations(spark, sf_dir).withColumns({"x": F.floor(F.col("k") * 7 / 16), "y": F.floor(F.col("altitude_ft") / 1600)})
    g = o.groupBy("x", "y").agg(F.countDistinct("day").alias("days"), F.count("*").alias("points"))
    total = o.agg(F.count("*").alias("total"))
    kept = g.join(F.broadcast(total)).where("days >= 5 and points <= 0.08 * total").drop("total")
    n = o.groupBy("x", "y", "aircraft").agg(F.count("*").alias("c"))
    top = A.top_k(n, ["x", "y"], 3, [F.desc("c"), F.col("aircraft")]).groupBy("x", "y").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "aircraft"))), lambda r: r["aircraft"]), ",").alias("top_aircraft"))
    return kept.join(top, ["x", "y"])


def geo_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with medians and the value at index int(0.9 n) of the sorted values."""
    o = observations(spark, sf_dir).withColumns({"cell_y": F.floor(F.col("lat") / F.lit(0.1)).cast("long"), "cell_x": F.floor(F.col("lon") / F.lit(0.1)).cast("long")})
    cell = Window.partitionBy("cell_y", "cell_x")
    o = o.withColumns({"_i": F.row_number().over(cell.orderBy("value")) - 1, "_n": F.count("*").over(cell)})
    g = o.groupBy("cell_y", "cell_x").agg(
        F.countDistinct("day").alias("days"), F.countDistinct("aircraft").alias("aircraft"), F.round(F.median("lat"), 6).alias("lat"), F.round(F.median("lon"), 6).alias("lon"),
        F.max(F.when(F.col("_i") == F.floor(F.col("_n") * 0.9), F.col("value"))).alias("p90"),
    )
    return g.where("days >= 5 and aircraft >= 10")


def cooccurrence_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments bought by one customer's orders as a weighted graph with degrees."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    v = l.join(p, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand").distinct()
    e = v.withColumnRenamed("p_brand", "a").join(v.withColumnRenamed("p_brand", "b"), "l_orderkey").where("a < b").groupBy("a", "b").agg(F.count("*").alias("weight"))
    both = e.select("a", "weight").union(e.select("b", "weight"))
    degree = both.groupBy("a").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))
    return e.join(degree, "a").where("weight >= 2")


def poi_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    s = o.groupBy("kind", "corridor_id").agg(F.count("*").alias("sightings"), F.countDistinct("aircraft").alias("aircraft"))
    n = o.groupBy("kind", "corridor_id", "aircraft").agg(F.count("*").alias("c"))
    top = A.top_k(n, ["kind", "corridor_id"], 1, [F.desc("c"), F.col("aircraft")]).select("kind", "corridor_id", F.col("aircraft").alias("top_aircraft"))
    return s.join(top, ["kind", "corridor_id"])


def aircraft_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.groupBy("aircraft").agg(F.countDistinct("day").alias("flights"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.min_by("kind", F.struct("ts", "obs_id")).alias("first_kind"))


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.select("obs_id", F.col("kind").alias("detector"), F.col("confidence").alias("score"), (F.col("altitude_ft") % 100 < F.col("confidence") * 90).alias("truth"))


_TRUTH = "t AS (SELECT obs_id, kind AS detector, confidence AS score, altitude_ft % 100 < confidence * CAST(90 AS DOUBLE) AS truth FROM obs)"


def reliability_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.reliability_bins(_truth(spark, sf_dir), "detector", "score", "truth")
    return b.select("detector", "bin", "n", *[F.round(c, 6).alias(c) for c in ("expected", "observed", "gap")])


def reliability_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.reliability_bins(_truth(spark, sf_dir), "detector", "score", "truth")
    return b.groupBy("detector").agg(F.round(F.sum(F.abs("gap") * F.col("n")) / F.sum("n"), 6).alias("mean_gap"), F.round(F.max(F.abs("gap")), 6).alias("max_gap"), F.count_if(F.abs("gap") > 0.05).alias("review_bins"))


def fitted_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustment clamp(precision - mean score, -1, 0), and the smallest cut that keeps a precision of 0.6."""
    t = _truth(spark, sf_dir)
    a = t.groupBy("detector").agg(F.greatest(F.lit(-1.0), F.least(F.lit(0.0), F.round(F.avg(F.col("truth").cast("double")) - F.avg("score"), 6))).alias("adjustment"))
    cuts = t.groupBy("detector", "score").agg(F.count("*").alias("n"), F.sum(F.col("truth").cast("int")).alias("good"))
    down = Window.partitionBy("detector").orderBy(F.desc("score"))
    kept = cuts.withColumn("precision", F.sum("good").over(down) / F.sum("n").over(down)).where("precision >= 0.6")
    return a.join(kept.groupBy("detector").agg(F.min("score").alias("cut")), "detector", "left")


def persistence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean match over epochs other than the candidate's own, with counts of near epochs."""
    o = observations(spark, sf_dir)
    g = o.groupBy("aircraft").agg(F.round(F.avg(F.when(F.dayofmonth("day") > 7, F.col("confidence"))), 6).alias("persistence"), F.count_if(F.dayofmonth("day").between(8, 14)).alias("near"), F.count_if(F.dayofmonth("day") > 7).alias("epochs"))
    return g.withColumn("status", F.when(F.col("epochs") < 2, "insufficient").when(F.col("persistence") >= 0.5, "persistent").otherwise("transient"))


def render_difference_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).withColumn("present", F.col("confidence") >= 0.3)
    return o.groupBy("aircraft", "corridor_id").agg(F.countDistinct("kind").alias("renders"), (F.bool_or("present") & ~F.bool_and("present")).alias("varies"), F.round(F.avg("confidence"), 6).alias("mean"))


def affine_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line of value on index by aircraft and the median residual."""
    o = observations(spark, sf_dir).withColumn("x", F.col("k").cast("double"))
    f = A.affine_fit(o, "aircraft", "x", "value")
    r = o.join(f, "aircraft").groupBy("aircraft").agg(F.median(F.abs(F.col("value") - F.col("a") - F.col("b") * F.col("x"))).alias("m"))
    return f.join(r, "aircraft").select("aircraft", "n", *[F.round(c, 5).alias(c) for c in ("a", "b", "m")])


def route_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.groupBy("kind", F.floor(F.col("lat") * 10).alias("lat_bucket"), F.floor(F.col("lon") * 10).alias("lon_bucket")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean"), F.min("confidence").alias("low"), F.max("confidence").alias("high"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def sparse_source_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    sparse = o.groupBy("aircraft", "day").agg(F.count("*").alias("n")).where("n < 3").select(F.concat_ws("|", "aircraft", "day").alias("item"), F.lit("sparse_source").alias("reason"))
    low = o.where("confidence < 0.05").select(F.col("obs_id").cast("string").alias("item"), F.lit("low_confidence").alias("reason"))
    error = o.where("kind = 'error' and value > 30").select(F.col("obs_id").cast("string").alias("item"), F.lit("error").alias("reason"))
    return sparse.unionByName(low).unionByName(error)


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 vertices of each track with stable ids."""
    o = observations(spark, sf_dir)
    t = A.top_k(o, ["aircraft"], 200, [F.col("ts"), F.col("obs_id")])
    return t.select(text.stable_id("node_", F.col("aircraft"), F.col("rank")).alias("node_id"), "aircraft", "rank", "obs_id")


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between following vertices of a track."""
    n = graph_nodes(spark, sf_dir)
    after = F.lead("node_id").over(Window.partitionBy("aircraft").orderBy("rank"))
    return n.select(F.col("node_id").alias("from_id"), after.alias("to_id"), "aircraft").where("to_id is not null")


def coverage_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, e = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")
    return c.select(F.col("c_custkey").alias("id")).subtract(e.select(F.col("user_id").alias("id")))


def coverage_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, e = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")
    return c.select(F.col("c_custkey").alias("id")).intersect(e.select(F.col("user_id").alias("id")))


def tail_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("tail")).agg(F.count("*").alias("orders"))
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("tail")).agg(F.count("*").alias("events"), F.countDistinct("event_type").alias("kinds"))
    return o.join(e, "tail", "full_outer").na.fill(0)


def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each hash is primary, later ones its duplicates."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("primary_id"))
    return d.join(first, "h").where("doc_id <> primary_id").select("doc_id", F.col("primary_id").alias("duplicate_of"))


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _truth(spark, sf_dir)
    cuts = spark.range(1, 10).select((F.col("id") / 10.0).alias("cut"))
    m = t.join(F.broadcast(cuts), F.col("score") >= F.col("cut"))
    return m.groupBy("detector", "cut").agg(F.count("*").alias("kept"), F.count_if("truth").alias("good"))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas by stratum, then a fill from the rest up to 50."""
    o = observations(spark, sf_dir).select("obs_id", "kind")
    ranked = A.top_k(o.where("kind in ('error', 'click')"), ["kind"], 15, [F.col("obs_id")]).select("obs_id", "kind")
    fill = o.join(ranked, "obs_id", "left_anti").orderBy("obs_id").limit(20)
    return ranked.unionByName(fill)


def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("split", F.when(F.col("doc_id") % 10 < 8, "train").otherwise("test"))
    return d.groupBy(F.sha2("text", 256).alias("scene")).agg(F.countDistinct("split").alias("splits")).where("splits > 1")


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).agg(F.count("*").alias("n")).withColumn("name", F.lit(t)) for t in ("customer", "orders", "lineitem", "events", "documents")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def heading_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted circular mean of headings by aircraft, as a unit vector."""
    o = observations(spark, sf_dir).withColumn("r", F.radians((F.col("altitude_ft") % 360).cast("double")))
    return o.groupBy("aircraft").agg(F.round(F.avg(F.cos("r") * F.col("confidence")), 6).alias("east"), F.round(F.avg(F.sin("r") * F.col("confidence")), 6).alias("north"))


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustments fitted on the first and the second half of the month, side by side."""
    o = observations(spark, sf_dir)
    half = lambda cond, name: o.where(cond).groupBy("kind").agg(F.round(F.avg("confidence"), 6).alias(name))
    return half("day < '2024-01-16'", "active").join(half("day >= '2024-01-16'", "fitted"), "kind", "full_outer").withColumn("delta", F.round(F.col("fitted") - F.col("active"), 6))


QUERIES = {f.__name__: f for f in (coverage_counts, zone_quality, two_key_histogram, exact_duplicate_groups, grouped_labels, route_edges, grid_density, poi_candidates, corridor_membership, batch_status_pivot, positional_clusters, geo_clusters, cooccurrence_edges, poi_sightings, aircraft_profiles, reliability_bins, reliability_report, fitted_adjustments, persistence_scores, render_difference_labels, affine_fits, route_clusters, sparse_source_review, graph_nodes, graph_edges, coverage_difference, coverage_intersection, tail_candidates, file_audit, threshold_sweep, stratified_sample, split_leakage, table_row_counts, heading_mean, drift_report)}

_D = "CAST({} AS DOUBLE)"
_BINS = f"{OBS}, {_TRUTH}, b AS (SELECT detector, least(9, CAST(trunc(score * 10) AS INT)) AS bin, count(*) AS n, avg(score) AS expected, avg(CAST(truth AS DOUBLE)) AS observed FROM t GROUP BY 1, 2)"
_T = "least(1.0, greatest(0.0, CASE WHEN (bx-ax)*(bx-ax)+(by_-ay)*(by_-ay) = 0 THEN 0.0 ELSE ((lon-ax)*(bx-ax)+(lat-ay)*(by_-ay))/((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)) END))"
_PY, _PX = f"(ay + {_T} * (by_ - ay))", f"(ax + {_T} * (bx - ax))"
_NM = f"2 * 3440.065 * asin(sqrt(least(1.0, pow(sin(radians({_PY} - lat) / 2), 2) + cos(radians(lat)) * cos(radians({_PY})) * pow(sin(radians({_PX} - lon) / 2), 2))))"
ORACLE = {
    "coverage_counts": f"WITH {OBS} SELECT count(*) AS n, count(DISTINCT aircraft) AS aircraft, count(*) FILTER (confidence >= 0.7) AS high, count(*) FILTER (lat > 18.2 AND kind = 'view') AS located_views, count(DISTINCT day) AS days FROM obs",
    "zone_quality": f"WITH {OBS} SELECT kind, count(*) AS n, CAST(sum(CASE WHEN confidence < 0.4 THEN 1 ELSE 0 END) AS BIGINT) AS low, round(avg(coalesce(confidence, 0)), 4) AS mean_confidence FROM obs GROUP BY 1",
    "two_key_histogram": f"WITH {OBS} SELECT kind, CASE WHEN confidence >= 0.7 THEN 'HIGH' WHEN confidence >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS severity, count(*) AS n FROM obs GROUP BY 1, 2",
    "exact_duplicate_groups": "WITH g AS (SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1) SELECT *, CAST(row_number() OVER (ORDER BY first_doc) AS INT) AS dup_group_id FROM g",
    "grouped_labels": "SELECT p_brand, p_size, string_agg(p_name, ' | ' ORDER BY p_partkey) AS names FROM part GROUP BY 1, 2",
    "route_edges": "WITH t AS (SELECT c_nationkey, s_nationkey, l_quantity, c_mktsegment, l_orderkey * 10 + l_linenumber AS seen FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey), m AS (SELECT c_nationkey, s_nationkey, c_mktsegment FROM t GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY c_nationkey, s_nationkey ORDER BY count(*) DESC, min(seen)) = 1) SELECT c_nationkey, s_nationkey, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity, any_value(m.c_mktsegment) AS c_mktsegment, least(1.0, count(*) / CAST(5.0 AS DOUBLE)) AS confidence FROM t JOIN m USING (c_nationkey, s_nationkey) GROUP BY 1, 2",
    "grid_density": f"WITH {OBS}, g AS (SELECT CAST(round_even(lat / CAST(0.05 AS DOUBLE), 0) AS INT) AS cell_y, CAST(round_even(lon / CAST(0.05 AS DOUBLE), 0) AS INT) AS cell_x, CAST(count(*) AS DOUBLE) AS weight FROM obs GROUP BY 1, 2), i AS (SELECT *, least(1.0, weight / CAST(10.0 AS DOUBLE)) AS intensity FROM g) SELECT *, CASE WHEN intensity >= 0.75 THEN 'red' WHEN intensity >= 0.5 THEN 'orange' WHEN intensity >= 0.25 THEN 'yellow' ELSE 'blue' END AS band FROM i",
    "poi_candidates": f"WITH {OBS}, g AS (SELECT CAST(trunc(lat / CAST(0.05 AS DOUBLE)) AS INT) AS cell_y, CAST(trunc(lon / CAST(0.05 AS DOUBLE)) AS INT) AS cell_x, count(*) AS points, count(DISTINCT aircraft) AS flights, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, count(*) FILTER (speed_mph < 60) / CAST(count(*) AS DOUBLE) AS loiter, count(DISTINCT day) AS days FROM obs GROUP BY 1, 2) SELECT cell_y, cell_x, points, flights, lat, lon, round({_D.format(0.30)} * least(1.0, points / {_D.format(20)}) + {_D.format(0.25)} * least(1.0, flights / {_D.format(10)}) + {_D.format(0.20)} * least(1.0, days / {_D.format(10)}) + {_D.format(0.25)} * loiter, 4) AS score FROM g WHERE points >= 3 AND flights >= 2",
    "corridor_membership": f"WITH {OBS}, l(lane, ax, ay, bx, by_) AS (VALUES (1, {_D.format(-67.2)}, {_D.format(17.95)}, {_D.format(-65.3)}, {_D.format(18.6)}), (2, {_D.format(-67.0)}, {_D.format(18.5)}, {_D.format(-65.5)}, {_D.format(18.0)})), g AS (SELECT aircraft, lane, CAST(sum(CASE WHEN {_NM} <= 3.5 THEN 1 ELSE 0 END) AS BIGINT) AS inside, count(*) AS n FROM obs CROSS JOIN l WHERE kind = 'view' GROUP BY 1, 2) SELECT *, round(inside / CAST(n AS DOUBLE), 6) AS confidence FROM g WHERE round(inside / CAST(n AS DOUBLE), 6) > 0.3",
    "batch_status_pivot": "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\", count(DISTINCT o_custkey) AS images FROM orders GROUP BY 1",
    "positional_clusters": f"WITH {OBS}, p AS (SELECT *, CAST(floor(k * 7 / {_D.format(16)}) AS BIGINT) AS x, CAST(floor(altitude_ft / {_D.format(1600)}) AS BIGINT) AS y FROM obs), g AS (SELECT x, y, count(DISTINCT day) AS days, count(*) AS points FROM p GROUP BY 1, 2), t AS (SELECT x, y, aircraft, row_number() OVER (PARTITION BY x, y ORDER BY count(*) DESC, aircraft) AS r FROM p GROUP BY 1, 2, 3), a AS (SELECT x, y, string_agg(aircraft, ',' ORDER BY r) AS top_aircraft FROM t WHERE r <= 3 GROUP BY 1, 2) SELECT x, y, days, points, top_aircraft FROM g JOIN a USING (x, y) WHERE days >= 5 AND points <= 0.08 * (SELECT count(*) FROM obs)",
    "geo_clusters": f"WITH {OBS}, g AS (SELECT CAST(floor(lat / {_D.format(0.1)}) AS BIGINT) AS cell_y, CAST(floor(lon / {_D.format(0.1)}) AS BIGINT) AS cell_x, count(DISTINCT day) AS days, count(DISTINCT aircraft) AS aircraft, round(median(lat), 6) AS lat, round(median(lon), 6) AS lon, list_sort(list(value)) AS v FROM obs GROUP BY 1, 2) SELECT cell_y, cell_x, days, aircraft, lat, lon, v[CAST(floor(len(v) * 0.9) AS INT) + 1] AS p90 FROM g WHERE days >= 5 AND aircraft >= 10",
    "cooccurrence_edges": "WITH v AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey), e AS (SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS weight FROM v x JOIN v y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY 1, 2), d AS (SELECT a, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS weighted_degree FROM (SELECT a, weight FROM e UNION ALL SELECT b, weight FROM e) GROUP BY 1) SELECT a, b, weight, degree, weighted_degree FROM e JOIN d USING (a) WHERE weight >= 2",
    "poi_sightings": f"WITH {OBS}, s AS (SELECT kind, corridor_id, count(*) AS sightings, count(DISTINCT aircraft) AS aircraft FROM obs GROUP BY 1, 2), t AS (SELECT kind, corridor_id, aircraft AS top_aircraft FROM obs GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY kind, corridor_id ORDER BY count(*) DESC, aircraft) = 1) SELECT * FROM s JOIN t USING (kind, corridor_id)",
    "aircraft_profiles": f"WITH {OBS} SELECT aircraft, count(DISTINCT day) AS flights, min(ts) AS first_seen, max(ts) AS last_seen, first(kind ORDER BY ts, obs_id) AS first_kind FROM obs GROUP BY 1",
    "reliability_bins": f"WITH {_BINS} SELECT detector, bin, n, round(expected, 6) AS expected, round(observed, 6) AS observed, round(observed - expected, 6) AS gap FROM b",
    "reliability_report": f"WITH {_BINS} SELECT detector, round(sum(abs(observed - expected) * n) / sum(n), 6) AS mean_gap, round(max(abs(observed - expected)), 6) AS max_gap, count(*) FILTER (abs(observed - expected) > 0.05) AS review_bins FROM b GROUP BY 1",
    "fitted_adjustments": f"WITH {OBS}, {_TRUTH}, a AS (SELECT detector, greatest(-1.0, least(0.0, round(avg(CAST(truth AS DOUBLE)) - avg(score), 6))) AS adjustment FROM t GROUP BY 1), c AS (SELECT detector, score, count(*) AS n, sum(CAST(truth AS INT)) AS good FROM t GROUP BY 1, 2), p AS (SELECT detector, score, sum(good) OVER w / CAST(sum(n) OVER w AS DOUBLE) AS pr FROM c WINDOW w AS (PARTITION BY detector ORDER BY score DESC)) SELECT detector, adjustment, (SELECT min(score) FROM p WHERE p.detector = a.detector AND pr >= 0.6) AS cut FROM a",
    "persistence_scores": f"WITH {OBS}, g AS (SELECT aircraft, round(avg(CASE WHEN day(day) > 7 THEN confidence END), 6) AS persistence, count(*) FILTER (day(day) BETWEEN 8 AND 14) AS near, count(*) FILTER (day(day) > 7) AS epochs FROM obs GROUP BY 1) SELECT *, CASE WHEN epochs < 2 THEN 'insufficient' WHEN persistence >= 0.5 THEN 'persistent' ELSE 'transient' END AS status FROM g",
    "render_difference_labels": f"WITH {OBS} SELECT aircraft, corridor_id, count(DISTINCT kind) AS renders, bool_or(confidence >= 0.3) AND NOT bool_and(confidence >= 0.3) AS varies, round(avg(confidence), 6) AS mean FROM obs GROUP BY 1, 2",
    "affine_fits": f"WITH {OBS}, f AS (SELECT aircraft, regr_intercept(value, CAST(k AS DOUBLE)) AS a, regr_slope(value, CAST(k AS DOUBLE)) AS b, count(*) AS n FROM obs GROUP BY 1) SELECT aircraft, any_value(n) AS n, round(any_value(a), 5) AS a, round(any_value(b), 5) AS b, round(median(abs(value - a - b * k)), 5) AS m FROM obs JOIN f USING (aircraft) GROUP BY 1",
    "route_clusters": f"WITH {OBS} SELECT kind, CAST(floor(lat * 10) AS BIGINT) AS lat_bucket, CAST(floor(lon * 10) AS BIGINT) AS lon_bucket, count(*) AS n, round(avg(confidence), 6) AS mean, min(confidence) AS low, max(confidence) AS high, min(ts) AS first_ts, max(ts) AS last_ts FROM obs GROUP BY 1, 2, 3",
    "sparse_source_review": f"WITH {OBS} SELECT aircraft || '|' || day AS item, 'sparse_source' AS reason FROM obs GROUP BY aircraft, day HAVING count(*) < 3 UNION ALL SELECT CAST(obs_id AS VARCHAR), 'low_confidence' FROM obs WHERE confidence < 0.05 UNION ALL SELECT CAST(obs_id AS VARCHAR), 'error' FROM obs WHERE kind = 'error' AND value > 30",
    "graph_edges": f"WITH {OBS}, r AS (SELECT aircraft, row_number() OVER (PARTITION BY aircraft ORDER BY ts, obs_id) AS rank FROM obs), n AS (SELECT *, 'node_' || substr(sha256(aircraft || '|' || rank), 1, 16) AS node_id FROM r WHERE rank <= 200) SELECT a.node_id AS from_id, b.node_id AS to_id, a.aircraft FROM n a JOIN n b ON a.aircraft = b.aircraft AND b.rank = a.rank + 1",
    "graph_nodes": f"WITH {OBS}, r AS (SELECT aircraft, CAST(row_number() OVER (PARTITION BY aircraft ORDER BY ts, obs_id) AS INT) AS rank, obs_id FROM obs) SELECT 'node_' || substr(sha256(aircraft || '|' || rank), 1, 16) AS node_id, * FROM r WHERE rank <= 200",
    "coverage_difference": "SELECT c_custkey AS id FROM customer EXCEPT SELECT user_id FROM events",
    "coverage_intersection": "SELECT c_custkey AS id FROM customer INTERSECT SELECT user_id FROM events",
    "tail_candidates": "WITH o AS (SELECT o_custkey AS tail, count(*) AS orders FROM orders GROUP BY 1), e AS (SELECT user_id AS tail, count(*) AS events, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1) SELECT tail, coalesce(orders, 0) AS orders, coalesce(events, 0) AS events, coalesce(kinds, 0) AS kinds FROM o FULL OUTER JOIN e USING (tail)",
    "file_audit": "WITH f AS (SELECT sha256(text) AS h, min(doc_id) AS p FROM documents GROUP BY 1) SELECT doc_id, p AS duplicate_of FROM documents JOIN f ON sha256(text) = h WHERE doc_id <> p",
    "threshold_sweep": f"WITH {OBS}, {_TRUTH} SELECT detector, i / CAST(10.0 AS DOUBLE) AS cut, count(*) AS kept, count(*) FILTER (truth) AS good FROM t JOIN (SELECT unnest(range(1, 10)) AS i) ON score >= i / CAST(10.0 AS DOUBLE) GROUP BY 1, 2",
    "stratified_sample": f"WITH {OBS}, r AS (SELECT obs_id, kind FROM obs WHERE kind IN ('error', 'click') QUALIFY row_number() OVER (PARTITION BY kind ORDER BY obs_id) <= 15) SELECT * FROM r UNION ALL (SELECT obs_id, kind FROM obs WHERE obs_id NOT IN (SELECT obs_id FROM r) ORDER BY obs_id LIMIT 20)",
    "split_leakage": "SELECT sha256(text) AS scene, count(DISTINCT CASE WHEN doc_id % 10 < 8 THEN 'train' ELSE 'test' END) AS splits FROM documents GROUP BY 1 HAVING splits > 1",
    "table_row_counts": " UNION ALL ".join(f"SELECT count(*) AS n, '{t}' AS name FROM {t}" for t in ("customer", "orders", "lineitem", "events", "documents")),
    "heading_mean": f"WITH {OBS} SELECT aircraft, round(avg(cos(radians(altitude_ft % 360)) * confidence), 6) AS east, round(avg(sin(radians(altitude_ft % 360)) * confidence), 6) AS north FROM obs GROUP BY 1",
    "drift_report": f"WITH {OBS} SELECT kind, round(avg(confidence) FILTER (day < '2024-01-16'), 6) AS active, round(avg(confidence) FILTER (day >= '2024-01-16'), 6) AS fitted, round(round(avg(confidence) FILTER (day >= '2024-01-16'), 6) - round(avg(confidence) FILTER (day < '2024-01-16'), 6), 6) AS delta FROM obs GROUP BY 1",
}
