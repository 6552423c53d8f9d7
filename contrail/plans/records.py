"""Queries: records of packages and bridges, validation, governed values, communities, grids and worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import bands as B
from ..operators import graphs as R
from ..operators import joins as J
from ..operators.cuts import row_numbers
from .mapping import OBS, observations, table
from .matching import _FRAMES, _frames


def federation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as sources, entities, relationships, observations and alerts of a package: id, stream, confidence, links."""
    o = observations(spark, sf_dir)
    fid = lambda kind, *parts: text.stable_id(f"{kind}_", F.lit(kind), *parts, digits=32)
    src, ent = fid("src", F.col("corridor_id")), fid("ent", F.lit("observation"), F.col("obs_id"))
    sure = F.round("confidence", 4)
    sources = o.select("corridor_id").distinct().select(src.alias("id"), F.lit("sources").alias("stream"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("from_id"))
    sensors = o.select("corridor_id").distinct().select(fid("ent", F.lit("source"), F.col("corridor_id")).alias("id"), F.lit("entities").alias("stream"), F.lit(1.0).alias("confidence"), src.alias("from_id"))
    entities = o.select(ent.alias("id"), F.lit("entities").alias("stream"), sure.alias("confidence"), src.alias("from_id"))
    observed = o.select(fid("obs", F.col("obs_id")).alias("id"), F.lit("observations").alias("stream"), sure.alias("confidence"), ent.alias("from_id"))
    related = o.select(fid("rel", F.lit("observed_by"), F.col("obs_id")).alias("id"), F.lit("relationships").alias("stream"), sure.alias("confidence"), ent.alias("from_id"))
    alerts = o.where("kind = 'error' and confidence >= 0.9").select(fid("alt", F.col("obs_id")).alias("id"), F.lit("alerts").alias("stream"), sure.alias("confidence"), ent.alias("from_id"))
    return sources.union(sensors).union(entities).union(observed).union(related).union(alerts)


def bridge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights as bridge records: an interval, a line of at least two points (a flight's points, gathered in order), a gated
    class and a review status of the other side."""
    o = observations(spark, sf_dir)
    at = F.struct("ts", "obs_id")
    points = F.transform(F.array_sort(F.collect_list(F.struct("ts", "obs_id", F.format_string("[%.3f,%.3f]", F.round("lon", 3), F.round("lat", 3)).alias("p")))), lambda x: x["p"])
    g = o.groupBy("aircraft", "day").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), points.alias("p"), F.round(F.max("confidence"), 4).alias("score"), F.max_by("kind", at).alias("kind"))
    line = F.when(F.size("p") >= 2, F.concat(F.lit('{"type":"LineString","coordinates":['), F.array_join("p", ","), F.lit("]}")))
    mission = F.when(F.col("score") > 0.85, F.col("kind"))
    status = F.when(F.col("kind") == "view", "reviewed").when(F.col("kind") == "click", "needs_review").otherwise("unreviewed")
    return g.select("aircraft", "day", "start_ts", "end_ts", line.alias("geometry"), mission.alias("mission"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"), status.alias("review_status"))


def producer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations, sources, lineage and confidence of a producer's package, and what is skipped for lack of time or place."""
    o = observations(spark, sf_dir)
    ok = F.col("k") % 7 > 0
    sure = F.round((F.col("confidence") + F.col("k") / 100.0) / 2, 4)
    seen = o.where(ok)
    one = lambda stream, prefix, extra: seen.select(F.lit(stream).alias("stream"), F.concat(F.lit(prefix), F.col("obs_id").cast("string")).alias("id"), extra.alias("detail"))
    status = F.when(F.col("k") >= 50, "located").otherwise("approximate")
    skipped = o.where(~ok).select(F.lit("skipped").alias("stream"), F.col("obs_id").cast("string").alias("id"), F.lit("missing timestamp or coordinates").alias("detail"))
    return one("observations", "fr24-", status).union(one("sources", "src-", F.col("aircraft"))).union(one("lineage", "lin-", F.concat(F.lit("src-"), F.col("obs_id").cast("string")))).union(one("confidence", "conf-", F.format_string("%.4f", sure))).union(skipped)


def target_rows(spark: SparkSession, sf_dir: str, month: str | None = "2024-01", retry: bool = True, stale: int | None = 5, limit: int = 500) -> DataFrame:
    """Rows that a stage still has to do: by month, failed ones too if asked, those with an old stamp; the first by id."""
    o = observations(spark, sf_dir)
    want = (F.col("k") % 3 == 0) | (F.lit(retry) & (F.col("kind") == "error"))
    if stale is not None:
        want = want | (F.col("k") < stale)
    rows = o.where(want)
    rows = rows.where(F.col("month") == month) if month else rows
    rows = rows.orderBy("obs_id")
    return (rows.limit(limit) if limit else rows).select("obs_id", "kind")


def calibration_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors and warnings of a calibration set: adjustments outside -1..0, aliases without a target, ids that disagree."""
    p = table(spark, sf_dir, "part")
    adjust = p.where("p_size <= 5").select(F.col("p_brand").alias("name"), ((F.col("p_size") - 4) / 2.0).alias("value"))
    bad = adjust.where(~F.col("value").between(-1.0, 0.0)).select("name", F.lit("adjustment_range").alias("issue"), F.lit("error").alias("level"))
    alias = p.where("p_size = 7").select(F.concat("p_brand", F.lit("x")).alias("name"), "p_type").distinct()
    dangling = alias.join(p.where("p_size = 8").select("p_type").distinct(), "p_type", "left_anti").select("name", F.lit("alias_target").alias("issue"), F.lit("error").alias("level"))
    ids = p.groupBy("p_brand").agg(F.min("p_partkey").alias("a"), F.max("p_partkey").alias("b")).where("a % 2 <> b % 2").select(F.col("p_brand").alias("name"), F.lit("id_mismatch").alias("issue"), F.lit("warning").alias("level"))
    return bad.union(dangling).union(ids).groupBy("name", "issue", "level").agg(F.count("*").alias("n"))


def review_state_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a local review state that must not be taken: empty ids and statuses that are not allowed."""
    o = observations(spark, sf_dir).select("obs_id", F.when(F.col("k") % 13 == 0, " ").otherwise(F.col("aircraft")).alias("item"), F.when(F.col("kind") == "error", "confirmed").otherwise(F.col("kind")).alias("status"))
    why = F.concat_ws(",", F.when(F.trim("item") == "", "empty_id"), F.when(~F.col("status").isin("view", "click", "signup", "purchase"), "status"))
    return o.withColumn("why", why).where("why <> ''").select("obs_id", "why")


def imagery_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures as manifest rows: footprints held within the world, reliability by whether clouds are known."""
    o = observations(spark, sf_dir)
    cloud = F.when(F.col("k") % 3 > 0, F.col("k").cast("double"))
    half = F.col("k") / 1.0
    edge = lambda c, d, most: F.round(F.greatest(F.lit(-most), F.least(F.lit(most), F.col(c) + d)), 4)
    fit = F.when(cloud.isNull(), "unknown_cloud").when(cloud <= 20, "high").when(cloud <= 60, "medium").otherwise("low")
    return o.select("obs_id", edge("lat", -half, 90.0).alias("south"), edge("lat", half, 90.0).alias("north"), edge("lon", -half * 2, 180.0).alias("west"), edge("lon", half * 2, 180.0).alias("east"), fit.alias("reliability"))


def infrastructure_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a type, of an operator, or of a sector, with which filters each passes."""
    s = table(spark, sf_dir, "supplier")
    passes = F.concat_ws(",", F.when(F.col("s_nationkey") == 3, "type"), F.when(F.upper("s_name").contains("7"), "operator"), F.when(F.col("s_acctbal") > 5000, "sector"))
    return s.select("s_suppkey", passes.alias("passes")).where("passes <> ''")


def ground_truth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truths normalised (class by alias, flags as 0 or 1, confidence within 0..1) and added once by (image, class)."""
    o = observations(spark, sf_dir)
    kind = F.when(F.col("kind") == "click", "view").otherwise(F.col("kind"))
    rows = o.select(F.concat_ws("/", "aircraft", "day").alias("image"), kind.alias("cls"), F.when(F.col("k") % 4 == 0, "yes").when(F.col("k") % 4 == 1, "0").when(F.col("k") % 4 == 2, "TRUE").otherwise("?").alias("said"), F.col("confidence"), "obs_id")
    flag = F.when(F.lower("said").isin("1", "yes", "true"), 1).when(F.lower("said").isin("0", "no", "false"), 0)
    rows = rows.withColumn("flag", flag).where("flag is not null")
    first = lambda r: J.last_wins(r, ["image", "cls"], [F.col("obs_id")]).select("image", "cls", "flag", "obs_id")
    return J.insert_missing(first(rows.where("obs_id % 2 = 0")), first(rows), ["image", "cls"])


def aoi_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas with their detections: overlay, agreement between epochs, and ledger rows; areas without any give one too."""
    o = observations(spark, sf_dir)
    areas = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("aoi"))
    d = o.where("kind = 'error'").select((F.col("altitude_ft") % 31).alias("aoi"), "obs_id", "confidence", "day")
    d = d.withColumns({"overlay": F.round(F.least(F.lit(1.0), F.col("confidence") * 1.1), 4), "late": F.col("day") >= "2024-01-16"})
    g = d.groupBy("aoi").agg(F.count("*").alias("detections"), F.round(F.max("overlay"), 4).alias("best"), (F.bool_or("late") & F.bool_or(~F.col("late"))).alias("persists"))
    met = areas.join(g, "aoi", "left")
    state = F.when(F.col("detections").isNull(), "no_detections").when(F.col("persists") & (F.col("best") >= 0.8), "candidate").when(F.col("persists"), "review").otherwise("single_epoch")
    return met.select("aoi", F.coalesce("detections", F.lit(0)).alias("detections"), "best", state.alias("state"))


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings whose pairs of aircraft, at most ten minutes apart on a day and at least two of them, are the edges of a graph."""
    return observations(spark, sf_dir).select("aircraft", B.moment(F.col("ts"), 600).alias("at"))


def aircraft_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communities of aircraft seen together: how many there are, their sightings, and the first five aircraft and owners."""
    parts, degrees = B.communities(_seen(spark, sf_dir), "aircraft", "at", 600_000_000, 2)
    seen = observations(spark, sf_dir).groupBy(F.col("aircraft").alias("node")).agg(F.count("*").alias("sightings"))
    owners = table(spark, sf_dir, "customer").select(F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("node"), F.col("c_mktsegment").alias("owner"))
    n = parts.join(seen, "node").join(degrees, "node").join(owners, "node", "left").na.fill("?", ["owner"])
    most = [F.desc("sightings"), F.desc("weighted"), F.col("node")]
    listed = lambda rows, name, number, out: rows.groupBy("community").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", name, number))), lambda x: F.concat(x[name], F.lit("("), x[number], F.lit(")"))), ", ").alias(out))
    top = n.withColumn("_r", F.row_number().over(Window.partitionBy("community").orderBy(*most))).where("_r <= 5")
    by_owner = n.groupBy("community", "owner").agg(F.count("*").alias("n"), F.min(F.struct(-F.col("weighted"), "node")).alias("first"))
    main = by_owner.withColumn("_r", F.row_number().over(Window.partitionBy("community").orderBy(F.desc("n"), "first"))).where("_r <= 5")
    whole = n.groupBy("community").agg(F.count("*").alias("n_aircraft"), F.sum("sightings").alias("total_sightings"))
    return whole.join(listed(top, "node", "sightings", "top_aircraft"), "community").join(listed(main, "owner", "n", "owners"), "community")


def graph_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degree and weighted degree of each aircraft in the graph of those seen together."""
    return B.degrees(_seen(spark, sf_dir), "aircraft", "at", 600_000_000, 2)


def icon_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Icons by hash: most frequent first, each joins the first cluster whose icon is within four bits and 20 degrees of hue."""
    n = _frames(spark, sf_dir).groupBy("h").agg(F.count("*").alias("n"), F.round(F.avg(F.col("obs_id") * 37 % 360), 6).alias("hue"))
    ranked = row_numbers(n, [F.desc("n"), F.col("h")], "rank")
    pairs = J.hamming_pairs(ranked, "rank", "h", 4)
    hue = ranked.select("rank", "hue")
    met = pairs.join(hue.select(F.col("rank").alias("a"), F.col("hue").alias("ha")), "a").join(hue.select(F.col("rank").alias("b"), F.col("hue").alias("hb")), "b")
    gap = F.least(F.abs(F.col("ha") - F.col("hb")), 360 - F.abs(F.col("ha") - F.col("hb")))
    led = R.leader_groups(ranked.select(F.col("rank").alias("node")), met.where(gap <= 20).select("a", "b"))
    return ranked.join(led, F.col("rank") == F.col("node")).groupBy(F.col("leader").alias("cluster")).agg(F.count("*").alias("hashes"), F.sum("n").alias("icons"))


def _dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.groupBy(F.floor(F.col("lat") / F.lit(0.05)).cast("long").alias("y"), F.floor(F.col("lon") / F.lit(0.05)).cast("long").alias("x")).agg(F.avg("altitude_ft").alias("z"))


def grid_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope, curvature and roughness of a grid of heights by its 3 by 3 neighbourhoods."""
    s = R.stencil(_dem(spark, sf_dir), "z")
    four = ("v_0_1", "v_0_m1", "v_1_0", "v_m1_0")
    bend = sum((F.coalesce(F.col(c), F.col("v_0_0")) for c in four), F.lit(0.0)) - 4 * F.col("v_0_0")
    return s.select("y", "x", F.round(R.slope(5550.0), 5).alias("slope_deg"), F.round(bend, 5).alias("curvature"), F.round(R.roughness(), 5).alias("roughness"))


def track_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Principal axis of each track's points: its direction, how much longer it is than the other, and the shape that this
    makes."""
    o = observations(spark, sf_dir)
    g = o.groupBy("aircraft", "day").agg(F.count("*").alias("n"), F.var_pop("lon").alias("a"), F.var_pop("lat").alias("c"), F.covar_pop("lon", "lat").alias("b"))
    root = F.sqrt(F.pow(F.col("a") - F.col("c"), 2) + 4 * F.pow(F.col("b"), 2))
    g = g.withColumns({"l1": (F.col("a") + F.col("c") + root) / 2, "l2": F.greatest(F.lit(0.0), (F.col("a") + F.col("c") - root) / 2)})
    share = F.when(F.col("l1") <= 0, 0.0).otherwise(1 - F.sqrt(F.col("l2") / F.when(F.col("l1") > 0, F.col("l1"))))
    shape = F.when(F.col("n") < 3, "unknown").when(F.col("elongation") >= 0.8, "linear").when(F.col("elongation") <= 0.3, "loop").otherwise("curved")
    angle = F.degrees(F.atan2(2 * F.col("b"), F.col("a") - F.col("c"))) / 2
    return g.where("n >= 3").withColumn("elongation", F.round(share, 5)).select("aircraft", "day", F.round(angle, 4).alias("angle_deg"), "elongation", shape.alias("shape"))


def ui_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of screens as fractions of their size, in pixels."""
    parts = [("top_bar", 0.0, 0.0, 1.0, 0.16), ("map", 0.04, 0.08, 0.92, 0.64), ("panel", 0.0, 0.6, 1.0, 1.0), ("timeline", 0.0, 0.8, 1.0, 1.0)]
    o = observations(spark, sf_dir).select("obs_id", (F.lit(1000) + F.col("k")).alias("w"), (F.lit(2000) + F.col("altitude_ft") % 100).alias("h"))
    each = F.array(*[F.struct(F.lit(n).alias("region"), *[F.floor(F.col(s) * f + 1e-9).cast("int").alias(c) for c, s, f in (("x0", "w", a), ("y0", "h", b), ("x1", "w", c_), ("y1", "h", d))]) for n, a, b, c_, d in parts])
    return o.select("obs_id", F.explode(each).alias("r")).select("obs_id", "r.*")


def plane_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances on the plane and to a segment, the latter also as the rule has it that swaps the coordinates."""
    o = observations(spark, sf_dir)
    a, b = (18.0, -67.0), (18.4, -65.5)
    flat = geo.flat_m(F.lit(a[0]), F.lit(a[1]), F.col("lat"), F.col("lon"))
    near = geo.segment_nm(F.col("lon"), F.col("lat"), F.lit(a[1]), F.lit(a[0]), F.lit(b[1]), F.lit(b[0]))
    swapped = geo.segment_nm(F.col("lat"), F.col("lon"), F.lit(a[0]), F.lit(a[1]), F.lit(b[0]), F.lit(b[1]))
    return o.select("obs_id", F.round(flat, 3).alias("flat_m"), F.round(near, 5).alias("segment_nm"), F.round(swapped, 5).alias("swapped_nm"))


def daily_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's work: open rows of tails that are not complete, by priority, expiry, date and time, up to the quota."""
    o = observations(spark, sf_dir)
    done = o.groupBy("aircraft").agg(F.count_if(F.col("kind") == "purchase").alias("p")).where("p >= 18").select("aircraft")
    rows = o.where("kind = 'error'").join(done, "aircraft", "left_anti").withColumn("expires", F.expr("date_add(day, cast(k % 5 as int))"))
    return rows.orderBy((F.col("k") % 3), "expires", "day", "ts", "obs_id").limit(60).select("obs_id", "aircraft", "expires")


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most recent runs with their counts."""
    o = observations(spark, sf_dir)
    runs = o.groupBy("day").agg(F.count("*").alias("inputs"), F.count_if(F.col("kind") == "error").alias("failed"))
    return runs.orderBy(F.desc("day")).limit(10)


def otsu_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut of each kind's values into two classes that lie farthest apart, over whole numbers, the least of equals."""
    o = observations(spark, sf_dir).select("kind", F.floor("value").cast("long").alias("v"))
    h = o.groupBy("kind", "v").agg(F.count("*").alias("n"))
    every, upto = Window.partitionBy("kind"), Window.partitionBy("kind").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumns({"w0": F.sum("n").over(upto), "s0": F.sum(F.col("n") * F.col("v")).over(upto), "w": F.sum("n").over(every), "s": F.sum(F.col("n") * F.col("v")).over(every)}).where("w0 < w")
    mean = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / (F.col("w") - F.col("w0"))
    between = F.round(F.col("w0").cast("double") * (F.col("w") - F.col("w0")) * mean * mean, 3)
    best = h.withColumn("b", between).groupBy("kind").agg(F.max(F.struct("b", (-F.col("v")).alias("o"))).alias("x"))
    return best.select("kind", (-F.col("x.o")).alias("threshold"))


def inverse_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at places as means of the observations within 15 km, weighed by the inverse square of their distance."""
    s = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("place"), (F.lit(17.95) + F.col("n_nationkey") * 0.02).alias("a_lat"), (F.lit(-67.0) + F.col("n_nationkey") * 0.05).alias("a_lon"))
    o = observations(spark, sf_dir).where("kind = 'view'").select("lat", "lon", "value")
    met = J.radius_join(o, s, 15.0, ("lat", "lon"), ("a_lat", "a_lon"))
    w = 1.0 / F.pow(F.greatest(F.col("distance_km"), F.lit(0.01)), 2)
    return met.groupBy("place").agg(F.round(F.sum(w * F.col("value")) / F.sum(w), 5).alias("estimate"), F.count("*").alias("n"))


def tile_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes around points, held to the area, and the tiles of their corners and centre."""
    o = observations(spark, sf_dir)
    d = F.lit(0.02) + (F.col("k") % 5) / 50.0
    box = {"south": F.greatest(F.lit(17.95), F.col("lat") - d), "west": F.greatest(F.lit(-67.25), F.col("lon") - d), "north": F.least(F.lit(18.6), F.col("lat") + d), "east": F.least(F.lit(-65.25), F.col("lon") + d)}
    b = o.select("obs_id", *[F.round(c, 6).alias(n) for n, c in box.items()])
    (x0, y0), (x1, y1) = geo.tile(F.col("north"), F.col("west"), 12), geo.tile(F.col("south"), F.col("east"), 12)
    return b.select("obs_id", "south", "west", "north", "east", x0.alias("x0"), y0.alias("y0"), ((x1 - x0 + 1) * (y1 - y0 + 1)).alias("tiles"))


QUERIES = {
    f.__name__: f
    for f in (
        federation_rows, bridge_records, producer_records, target_rows, calibration_validation, review_state_validation, imagery_manifest, infrastructure_filter, ground_truth_rows,
        aoi_chain, aircraft_communities, graph_degrees, icon_clusters, grid_terrain, track_vectors, ui_regions, plane_distances, daily_worklist, recent_runs, otsu_thresholds, inverse_distance, tile_boxes,
    )
}


def _fid(kind: str, *parts: str) -> str:
    return f"'{kind}_' || substr(sha256('{kind}' || {' || '.join(f"'|' || {p}" for p in parts)}), 1, 32)"


def _seg(px: str, py: str, ax: float, ay: float, bx: float, by: float) -> str:
    dx, dy = f"(CAST({bx} AS DOUBLE) - CAST({ax} AS DOUBLE))", f"(CAST({by} AS DOUBLE) - CAST({ay} AS DOUBLE))"
    t = f"greatest(0.0, least(1.0, (({px} - CAST({ax} AS DOUBLE)) * {dx} + ({py} - CAST({ay} AS DOUBLE)) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    from .mapping import hav_sql

    return hav_sql(py, px, f"(CAST({ay} AS DOUBLE) + {t} * {dy})", f"(CAST({ax} AS DOUBLE) + {t} * {dx})", 3440.065)


_EDGES = "e AS (SELECT x.aircraft AS a, y.aircraft AS b, count(*) AS weight FROM obs x JOIN obs y ON x.day = y.day AND x.aircraft < y.aircraft AND abs(epoch_us(x.ts) - epoch_us(y.ts)) <= 600000000 GROUP BY 1, 2 HAVING count(*) >= 2)"
_TILE_Y = "CAST(floor((1.0 - ln(tan(radians({0})) + 1.0 / cos(radians({0}))) / pi()) / 2.0 * 4096.0) AS BIGINT)"
_TILE_X = "CAST(floor(({0} + 180.0) / 360.0 * 4096.0) AS BIGINT)"
ORACLE = {
    "federation_rows": f"WITH {OBS}, c AS (SELECT DISTINCT corridor_id FROM obs) SELECT {_fid('src', 'corridor_id')} AS id, 'sources' AS stream, CAST(1.0 AS DOUBLE) AS confidence, NULL AS from_id FROM c UNION ALL SELECT {_fid('ent', chr(39) + 'source' + chr(39), 'corridor_id')}, 'entities', 1.0, {_fid('src', 'corridor_id')} FROM c UNION ALL SELECT {_fid('ent', chr(39) + 'observation' + chr(39), 'obs_id')}, 'entities', round(confidence, 4), {_fid('src', 'corridor_id')} FROM obs UNION ALL SELECT {_fid('obs', 'obs_id')}, 'observations', round(confidence, 4), {_fid('ent', chr(39) + 'observation' + chr(39), 'obs_id')} FROM obs UNION ALL SELECT {_fid('rel', chr(39) + 'observed_by' + chr(39), 'obs_id')}, 'relationships', round(confidence, 4), {_fid('ent', chr(39) + 'observation' + chr(39), 'obs_id')} FROM obs UNION ALL SELECT {_fid('alt', 'obs_id')}, 'alerts', round(confidence, 4), {_fid('ent', chr(39) + 'observation' + chr(39), 'obs_id')} FROM obs WHERE kind = 'error' AND confidence >= 0.9",
    "bridge_records": f"WITH {OBS}, g AS (SELECT aircraft, day, min(ts) AS start_ts, max(ts) AS end_ts, list('[' || printf('%.3f', round(lon, 3)) || ',' || printf('%.3f', round(lat, 3)) || ']' ORDER BY ts, obs_id) AS p, round(max(confidence), 4) AS score, last(kind ORDER BY ts, obs_id) AS kind FROM obs GROUP BY 1, 2) SELECT aircraft, day, start_ts, end_ts, CASE WHEN len(p) >= 2 THEN '{{\"type\":\"LineString\",\"coordinates\":[' || array_to_string(p, ',') || ']}}' END AS geometry, CASE WHEN score > 0.85 THEN kind END AS mission, score, CASE kind WHEN 'view' THEN 'reviewed' WHEN 'click' THEN 'needs_review' ELSE 'unreviewed' END AS review_status FROM g",
    "producer_records": f"WITH {OBS}, s AS (SELECT * FROM obs WHERE k % 7 > 0) SELECT 'observations' AS stream, 'fr24-' || obs_id AS id, CASE WHEN k >= 50 THEN 'located' ELSE 'approximate' END AS detail FROM s UNION ALL SELECT 'sources', 'src-' || obs_id, aircraft FROM s UNION ALL SELECT 'lineage', 'lin-' || obs_id, 'src-' || obs_id FROM s UNION ALL SELECT 'confidence', 'conf-' || obs_id, printf('%.4f', round((confidence + k / CAST(100 AS DOUBLE)) / 2, 4)) FROM s UNION ALL SELECT 'skipped', CAST(obs_id AS VARCHAR), 'missing timestamp or coordinates' FROM obs WHERE k % 7 = 0",
    "target_rows": f"WITH {OBS} SELECT obs_id, kind FROM obs WHERE (k % 3 = 0 OR kind = 'error' OR k < 5) AND month = '2024-01' ORDER BY obs_id LIMIT 500",
    "calibration_validation": "WITH i AS (SELECT p_brand AS name, 'adjustment_range' AS issue, 'error' AS level FROM part WHERE p_size <= 5 AND NOT (p_size - 4) / CAST(2 AS DOUBLE) BETWEEN -1 AND 0 UNION ALL SELECT name, 'alias_target', 'error' FROM (SELECT DISTINCT p_brand || 'x' AS name, p_type FROM part WHERE p_size = 7) WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size = 8) UNION ALL SELECT p_brand, 'id_mismatch', 'warning' FROM part GROUP BY 1 HAVING min(p_partkey) % 2 <> max(p_partkey) % 2) SELECT name, issue, level, count(*) AS n FROM i GROUP BY 1, 2, 3",
    "review_state_validation": f"WITH {OBS} SELECT obs_id, CASE WHEN k % 13 = 0 AND kind = 'error' THEN 'empty_id,status' WHEN k % 13 = 0 THEN 'empty_id' ELSE 'status' END AS why FROM obs WHERE k % 13 = 0 OR kind = 'error'",
    "imagery_manifest": f"WITH {OBS} SELECT obs_id, round(greatest(-90.0, lat - k), 4) AS south, round(least(90.0, lat + k), 4) AS north, round(greatest(-180.0, lon - k * 2), 4) AS west, round(least(180.0, lon + k * 2), 4) AS east, CASE WHEN k % 3 = 0 THEN 'unknown_cloud' WHEN k <= 20 THEN 'high' WHEN k <= 60 THEN 'medium' ELSE 'low' END AS reliability FROM obs",
    "infrastructure_filter": "SELECT s_suppkey, concat_ws(',', CASE WHEN s_nationkey = 3 THEN 'type' END, CASE WHEN contains(s_name, '7') THEN 'operator' END, CASE WHEN s_acctbal > 5000 THEN 'sector' END) AS passes FROM supplier WHERE s_nationkey = 3 OR contains(s_name, '7') OR s_acctbal > 5000",
    "ground_truth_rows": f"WITH {OBS}, r AS (SELECT aircraft || '/' || day AS image, CASE kind WHEN 'click' THEN 'view' ELSE kind END AS cls, CASE k % 4 WHEN 1 THEN 0 ELSE 1 END AS flag, obs_id FROM obs WHERE k % 4 <> 3) SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY image, cls ORDER BY obs_id % 2, obs_id) = 1",
    "aoi_chain": f"WITH {OBS}, d AS (SELECT altitude_ft % 31 AS aoi, count(*) AS detections, max(round(least(1.0, confidence * CAST(1.1 AS DOUBLE)), 4)) AS best, bool_or(day >= DATE '2024-01-16') AND bool_or(day < DATE '2024-01-16') AS p FROM obs WHERE kind = 'error' GROUP BY 1) SELECT CAST(n_nationkey AS BIGINT) AS aoi, coalesce(detections, 0) AS detections, best, CASE WHEN detections IS NULL THEN 'no_detections' WHEN p AND best >= 0.8 THEN 'candidate' WHEN p THEN 'review' ELSE 'single_epoch' END AS state FROM nation LEFT JOIN d ON aoi = n_nationkey",
    "graph_degrees": f"WITH {OBS}, {_EDGES} SELECT node, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS weighted FROM (SELECT a AS node, weight FROM e UNION ALL SELECT b, weight FROM e) GROUP BY 1",
    "icon_clusters": f"WITH {OBS}, {_FRAMES}, n AS (SELECT h, count(*) AS n, round(avg(obs_id * 37 % 360), 6) AS hue FROM f GROUP BY h), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, h) - 1 AS rank FROM n), e AS (SELECT a.rank AS a, b.rank AS b FROM r a JOIN r b ON a.rank < b.rank AND bit_count(xor(a.h, b.h)) <= 4 AND least(abs(a.hue - b.hue), 360 - abs(a.hue - b.hue)) <= 20), z AS (SELECT r.rank, list(a) FILTER (a IS NOT NULL) AS near FROM r LEFT JOIN e ON e.b = r.rank GROUP BY 1), w AS (SELECT list_reduce(list_prepend([]::BIGINT[], list(ids ORDER BY ids[1])), lambda led, x: CASE WHEN len(list_intersect(led, x[2:])) = 0 THEN list_append(led, x[1]) ELSE led END) AS led FROM (SELECT list_prepend(rank, coalesce(near, [])) AS ids FROM z)), g AS (SELECT z.rank, CASE WHEN list_contains(led, z.rank) THEN z.rank ELSE list_min(list_intersect(led, near)) END AS cluster FROM z, w) SELECT cluster, count(*) AS hashes, CAST(sum(n) AS BIGINT) AS icons FROM g JOIN r USING (rank) GROUP BY 1",
    "grid_terrain": f"WITH {OBS}, g AS (SELECT CAST(floor(lat / CAST(0.05 AS DOUBLE)) AS BIGINT) AS y, CAST(floor(lon / CAST(0.05 AS DOUBLE)) AS BIGINT) AS x, avg(altitude_ft) AS z FROM obs GROUP BY 1, 2), s AS (SELECT g.y, g.x, g.z, max(n.z) FILTER (n.y = g.y AND n.x = g.x + 1) AS e, max(n.z) FILTER (n.y = g.y AND n.x = g.x - 1) AS w, max(n.z) FILTER (n.y = g.y + 1 AND n.x = g.x) AS u, max(n.z) FILTER (n.y = g.y - 1 AND n.x = g.x) AS d, max(abs(n.z - g.z)) AS rough FROM g JOIN g n ON abs(n.y - g.y) <= 1 AND abs(n.x - g.x) <= 1 GROUP BY 1, 2, 3) SELECT y, x, round(degrees(atan(sqrt(pow((coalesce(e, z) - coalesce(w, z)) / CASE WHEN e IS NOT NULL AND w IS NOT NULL THEN 11100.0 ELSE 5550.0 END, 2) + pow((coalesce(u, z) - coalesce(d, z)) / CASE WHEN u IS NOT NULL AND d IS NOT NULL THEN 11100.0 ELSE 5550.0 END, 2)))), 5) AS slope_deg, round(coalesce(e, z) + coalesce(w, z) + coalesce(u, z) + coalesce(d, z) - 4 * z, 5) AS curvature, round(rough, 5) AS roughness FROM s",
    "track_vectors": f"WITH {OBS}, g AS (SELECT aircraft, day, count(*) AS n, var_pop(lon) AS a, var_pop(lat) AS c, covar_pop(lon, lat) AS b FROM obs GROUP BY 1, 2 HAVING count(*) >= 3), r AS (SELECT *, sqrt(pow(a - c, 2) + 4 * b * b) AS q FROM g), e AS (SELECT *, round(CASE WHEN a + c + q <= 0 THEN 0 ELSE 1 - sqrt(greatest(0.0, (a + c - q) / 2) / ((a + c + q) / 2)) END, 5) AS elongation FROM r) SELECT aircraft, day, round(degrees(atan2(2 * b, a - c)) / 2, 4) AS angle_deg, elongation, CASE WHEN elongation >= 0.8 THEN 'linear' WHEN elongation <= 0.3 THEN 'loop' ELSE 'curved' END AS shape FROM e",
    "ui_regions": f"WITH {OBS}, o AS (SELECT obs_id, 1000 + k AS w, 2000 + altitude_ft % 100 AS h FROM obs), p(region, a, b, c, d) AS (VALUES ('top_bar', 0, 0, 100, 16), ('map', 4, 8, 92, 64), ('panel', 0, 60, 100, 100), ('timeline', 0, 80, 100, 100)) SELECT obs_id, region, CAST(w * a // 100 AS INT) AS x0, CAST(h * b // 100 AS INT) AS y0, CAST(w * c // 100 AS INT) AS x1, CAST(h * d // 100 AS INT) AS y1 FROM o, p",
    "plane_distances": f"WITH {OBS} SELECT obs_id, round(sqrt(pow((lat - 18.0) * 111000.0, 2) + pow((lon + 67.0) * 111000.0 * cos(radians(CAST(18.0 AS DOUBLE))), 2)), 3) AS flat_m, round({_seg('lon', 'lat', -67.0, 18.0, -65.5, 18.4)}, 5) AS segment_nm, round({_seg('lat', 'lon', 18.0, -67.0, 18.4, -65.5)}, 5) AS swapped_nm FROM obs",
    "daily_worklist": f"WITH {OBS}, d AS (SELECT aircraft FROM obs GROUP BY 1 HAVING count(*) FILTER (kind = 'purchase') >= 18) SELECT obs_id, aircraft, day + CAST(k % 5 AS INT) AS expires FROM obs WHERE kind = 'error' AND aircraft NOT IN (SELECT aircraft FROM d) ORDER BY k % 3, day + CAST(k % 5 AS INT), day, ts, obs_id LIMIT 60",
    "recent_runs": f"WITH {OBS} SELECT day, count(*) AS inputs, count(*) FILTER (kind = 'error') AS failed FROM obs GROUP BY 1 ORDER BY 1 DESC LIMIT 10",
    "otsu_thresholds": f"WITH {OBS}, h AS (SELECT kind, CAST(floor(value) AS BIGINT) AS v, count(*) AS n FROM obs GROUP BY 1, 2), c AS (SELECT kind, v, CAST(sum(n) OVER u AS BIGINT) AS w0, CAST(sum(n * v) OVER u AS BIGINT) AS s0, CAST(sum(n) OVER (PARTITION BY kind) AS BIGINT) AS w, CAST(sum(n * v) OVER (PARTITION BY kind) AS BIGINT) AS s FROM h WINDOW u AS (PARTITION BY kind ORDER BY v)) SELECT kind, v AS threshold FROM c WHERE w0 < w QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(CAST(w0 AS DOUBLE) * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)), 3) DESC, v) = 1",
    "tile_boxes": f"WITH {OBS}, b AS (SELECT obs_id, round(greatest(CAST(17.95 AS DOUBLE), lat - d), 6) AS south, round(greatest(CAST(-67.25 AS DOUBLE), lon - d), 6) AS west, round(least(CAST(18.6 AS DOUBLE), lat + d), 6) AS north, round(least(CAST(-65.25 AS DOUBLE), lon + d), 6) AS east FROM (SELECT *, CAST(0.02 AS DOUBLE) + (k % 5) / CAST(50 AS DOUBLE) AS d FROM obs)), t AS (SELECT *, {_TILE_X.format('west')} AS x0, {_TILE_Y.format('north')} AS y0, {_TILE_X.format('east')} AS x1, {_TILE_Y.format('south')} AS y1 FROM b) SELECT obs_id, south, west, north, east, x0, y0, (x1 - x0 + 1) * (y1 - y0 + 1) AS tiles FROM t",
}


def _idw() -> str:
    from .mapping import hav_sql

    km = hav_sql("lat", "lon", "a_lat", "a_lon", 6371.0088)
    return f"WITH {OBS}, p AS (SELECT CAST(n_nationkey AS BIGINT) AS place, CAST(17.95 AS DOUBLE) + n_nationkey * CAST(0.02 AS DOUBLE) AS a_lat, CAST(-67.0 AS DOUBLE) + n_nationkey * CAST(0.05 AS DOUBLE) AS a_lon FROM nation), m AS (SELECT place, value, {km} AS d FROM obs, p WHERE kind = 'view') SELECT place, round(sum(value / pow(greatest(d, CAST(0.01 AS DOUBLE)), 2)) / sum(1 / pow(greatest(d, CAST(0.01 AS DOUBLE)), 2)), 5) AS estimate, count(*) AS n FROM m WHERE d <= 15 GROUP BY 1"


ORACLE["inverse_distance"] = _idw()
