"""Queries: predicates, contracts, text rules, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cards as C
from ..functions import geo, text
from .mapping import OBS, hav_sql, observations, table


def null_safe_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality on arbitrary columns, null equal to null."""
    l = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    wanted = {"quality": None, "lang": "en"}
    for k, v in wanted.items():
        l = l.where(F.col(k).eqNullSafe(F.lit(v)))
    return l.select("doc_id", "source")


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey = 7").select("o_orderkey", "o_custkey", "o_orderstatus").limit(1)


def box_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.where(geo.in_box(F.col("lat"), F.col("lon"), 18.0, -67.0, 18.3, -66.0)).select("obs_id", "aircraft")


def availability_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderstatus").isin("F", "P")).groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


def banned_label_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).withColumn("status", F.when(F.col("obs_id") % 13 == 0, " Confirmed ").otherwise("candidate"))
    return o.where(~text.has_banned(F.col("status"), F.col("kind"))).select("obs_id", "status")


def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's violations: ranges, enums and a foreign key."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    bad = o.join(c.where("c_acctbal > -500"), F.col("o_custkey") == F.col("c_custkey"), "left")
    errors = F.array_compact(F.array(
        F.when(F.col("c_custkey").isNull(), "unknown_customer"), F.when(~F.col("o_totalprice").between(1000, 400000), "price_range"),
        F.when(~F.col("o_orderstatus").isin("F", "O"), "status_enum"), F.when(F.col("o_orderpriority") == "5-LOW", "priority"),
    ))
    return bad.select("o_orderkey", F.array_join(errors, ",").alias("errors"), F.size(errors).alias("n_errors")).where("n_errors > 0")


def atomicity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spatial fields must be all null or all there, with an error of 500 m at most."""
    o = observations(spark, sf_dir).select("obs_id", F.when(F.col("obs_id") % 3 != 0, F.col("lat")).alias("a"), F.when(F.col("obs_id") % 4 != 0, F.col("lon")).alias("b"), (F.col("k") * 6).alias("error_m"))
    none, every = F.col("a").isNull() & F.col("b").isNull(), F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("error_m") <= 500)
    return o.where(~(none | every)).select("obs_id", "error_m")


def harvest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    age = F.datediff(F.lit("2024-01-31").cast("date"), F.col("day"))
    return o.groupBy(F.when(age > 25, "EXPIRED").when(age > 20, "EXPIRING").otherwise("AVAILABLE").alias("status"), age.alias("age")).agg(F.count("*").alias("n"))


def intake_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    events = o.where(F.col("kind").isin("view", "click")).select("obs_id", F.lit("event").alias("queue"), F.concat_ws("T", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")).alias("at"))
    hold = o.where(~F.col("kind").isin("view", "click")).select("obs_id", F.lit("hold").alias("queue"), F.lit(None).cast("string").alias("at"))
    return events.unionByName(hold)


def review_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = F.create_map(*[F.lit(x) for x in ("view", "reviewed", "click", "needs_review", "purchase", "accepted")])
    o = observations(spark, sf_dir)
    return o.groupBy(F.coalesce(F.try_element_at(table_, F.col("kind")), F.lit("unreviewed")).alias("status")).agg(F.count("*").alias("n"))


def normalized_air_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases in turn, 0 and blank counting as missing, with a stable id."""
    o = observations(spark, sf_dir)
    alt = F.coalesce(F.nullif("altitude_ft", F.lit(0)), F.nullif("k", F.lit(0)), F.lit(0))
    return o.select(text.stable_id("air_", F.col("aircraft"), F.col("obs_id"), alt).alias("event_id"), "aircraft", alt.alias("altitude_ft"), geo.clamp01(F.col("value") / 50.0).alias("confidence"))


def string_sorted_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any column sorted as text, missing first; a bounded page."""
    c = table(spark, sf_dir, "customer")
    return c.orderBy(F.coalesce(F.col("c_nationkey").cast("string"), F.lit("")).desc(), "c_custkey").limit(100).select("c_custkey", "c_nationkey")


def worklist_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score 3 x aircraft + screens + 2 x days, the best 25 ranked."""
    from pyspark.sql import Window

    o = observations(spark, sf_dir).withColumn("cell", geo.cell(F.col("lat"), 0.02))
    g = o.groupBy("cell", "kind").agg((3 * F.countDistinct("aircraft") + F.count("*") + 2 * F.countDistinct("day")).alias("score"))
    top = g.orderBy(F.desc("score"), "cell", "kind").limit(25)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "cell", "kind")))


def queue_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three bands: expiring, backed by the strongest wave, the rest; ranked within each corridor."""
    from pyspark.sql import Window

    o = observations(spark, sf_dir)
    wave = o.groupBy("aircraft").agg(F.count("*").alias("wave"))
    q = o.where("kind = 'error'").join(wave, "aircraft").withColumn("band", F.when(F.col("day") < "2024-01-05", 1).when(F.col("wave") >= 70, 2).otherwise(3))
    rank = F.row_number().over(Window.partitionBy("corridor_id").orderBy("band", F.desc("wave"), "obs_id"))
    return q.select("obs_id", "corridor_id", "band", rank.alias("rank"))


def heterogeneous_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


def _card(o: DataFrame) -> DataFrame:
    """Text of an aircraft card."""
    t = F.concat(F.lit("Reg N"), F.col("obs_id").cast("string"), F.lit("X ALT "), F.format_number(F.col("altitude_ft"), 0), F.lit(" ft SPEED "), F.floor("speed_mph").cast("string"), F.when(F.col("k") % 2 == 0, " kt").otherwise(" mph"), F.lit(" HEADING: "), (F.col("altitude_ft") % 360).cast("string"), F.when(F.col("k") % 3 == 0, " Bell 407").when(F.col("k") % 3 == 1, " R44").otherwise(""))
    return o.select("obs_id", t.alias("card"))


_CARD = "card AS (SELECT obs_id, 'Reg N' || obs_id || 'X ALT ' || format('{:,}', altitude_ft) || ' ft SPEED ' || CAST(floor(speed_mph) AS BIGINT) || CASE WHEN k % 2 = 0 THEN ' kt' ELSE ' mph' END || ' HEADING: ' || (altitude_ft % 360) || CASE k % 3 WHEN 0 THEN ' Bell 407' WHEN 1 THEN ' R44' ELSE '' END AS card FROM obs)"


def card_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration, altitude, speed, heading and type from the text of a card."""
    c = _card(observations(spark, sf_dir))
    card = F.col("card")
    number = lambda p: F.replace(C.first(card, p), F.lit(","), F.lit("")).try_cast("long")
    kinds = {n: card.rlike(p) for n, p in C.TYPES}
    return c.select(
        "obs_id", C.first(card, C.REGISTRATION[0], group=0).alias("registration"), number(C.SCAN_FEET).alias("altitude_ft"), number(C.SCAN_KNOTS).alias("speed_kt"), number(C.SCAN_MPH).alias("speed_mph"),
        number(C.HEADING).alias("heading"), F.when(kinds["B407"], "B407").when(kinds["AS350"], "AS350").when(kinds["R44"], "R44").alias("aircraft_type"),
    )


def tail_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" n"), F.col("p_partkey").cast("string"), F.lit("ab (x) "), F.col("p_brand"))
    return p.select("p_partkey", text.tail(raw).alias("tail"), text.n_number(F.concat(F.lit("N"), F.col("p_partkey").cast("string"), F.lit("AB"))).alias("valid"), text.confusable(raw).alias("folded"))


def edit_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.levenshtein("p_name", "p_type").alias("distance"), (text.confusable(F.col("p_name")) == text.confusable(F.col("p_type"))).alias("same"))


def unusual_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 to 3 rows for each observation: hour, duration and number of screenshots."""
    o = observations(spark, sf_dir)
    rules = F.array_compact(F.array(
        F.when((F.col("kind") == "error") & ~F.hour("ts").between(7, 18), "unusual_time"), F.when((F.col("kind") == "view") & (F.col("altitude_ft") / 60 > 150), "unusual_duration"), F.when(F.col("k") > 95, "potential_clustering_error"),
    ))
    return o.select("obs_id", F.explode(rules).alias("type"))


def keyword_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First family of keywords that a page's address meets."""
    p = table(spark, sf_dir, "pages")
    u = F.lower("url")
    kind = F.when(u.rlike("spam|pills"), "spam").when(u.rlike("blog"), "blog").when(u.rlike(r"//m\."), "mobile").otherwise("other")
    return p.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def path_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape of a day's path from its speeds."""
    o = observations(spark, sf_dir)
    g = o.groupBy("aircraft", "day").agg(F.collect_list("speed_mph").alias("v"))
    hover, fast = F.exists("v", lambda x: x < 10), F.exists("v", lambda x: x > 150)
    return g.select("aircraft", "day", F.when(F.size("v") < 2, "single").when(hover & fast, "mixed").when(hover, "hover").when(fast, "transit").otherwise("cruise").alias("shape"))


def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.stable_id("doc_", F.col("lang"), F.col("source"), F.col("n_chars"), digits=24).alias("content_id"), F.sha1("text").substr(1, 16).alias("sha1_16"))


def presence_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    fields = [F.when(F.col("k") % 2 == 0, "x"), F.when(F.col("k") % 3 == 0, " "), F.when(F.col("k") % 5 != 0, "y"), F.col("kind")]
    have = sum((F.when(text.blank_to_null(f).isNotNull(), 1).otherwise(0) for f in fields[1:]), F.when(text.blank_to_null(fields[0]).isNotNull(), 1).otherwise(0))
    s = o.select("obs_id", (have / F.lit(4.0)).alias("coverage"))
    return s.withColumn("tier", F.when(F.col("coverage") >= 0.75, 1).when(F.col("coverage") >= 0.5, 2).when(F.col("coverage") >= 0.25, 3).otherwise(4))


def slippy_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    x, y = geo.tile(F.col("lat"), F.col("lon"), 12)
    return o.groupBy(x.alias("x"), y.alias("y")).agg(F.count("*").alias("n"))


def distance_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    at = [F.col("lat"), F.col("lon"), F.lit(18.4), F.lit(-66.0)]
    return o.select("obs_id", *[F.round(geo.haversine(*at, u), 6).alias(u) for u in ("m", "km", "nm")], F.round(geo.to_mph(F.col("speed_mph"), F.lit("kt")), 6).alias("mph"))


QUERIES = {f.__name__: f for f in (null_safe_filter, point_lookup, box_filter, availability_filter, banned_label_guard, contract_errors, atomicity_violations, harvest_status, intake_split, review_crosswalk, normalized_air_events, string_sorted_page, worklist_top, queue_ranking, heterogeneous_union, card_fields, tail_normalization, edit_distances, unusual_patterns, keyword_classes, path_shapes, content_ids, presence_vector, slippy_tiles, distance_units)}

_FOLD = "translate(upper({}), 'OILSBZG', '0115826')"
_RAW = "(' n' || p_partkey || 'ab (x) ' || p_brand)"
_TO = ("lat", "lon", "CAST(18.4 AS DOUBLE)", "CAST(-66.0 AS DOUBLE)")
ORACLE = {
    "null_safe_filter": "SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL AND lang = 'en'",
    "point_lookup": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7",
    "box_filter": f"WITH {OBS} SELECT obs_id, aircraft FROM obs WHERE lat BETWEEN 18.0 AND 18.3 AND lon BETWEEN -67.0 AND -66.0",
    "availability_filter": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1, 2",
    "banned_label_guard": f"WITH {OBS} SELECT obs_id, 'candidate' AS status FROM obs WHERE obs_id % 13 <> 0",
    "contract_errors": "WITH e AS (SELECT o_orderkey, list_filter([CASE WHEN c_custkey IS NULL THEN 'unknown_customer' END, CASE WHEN NOT o_totalprice BETWEEN 1000 AND 400000 THEN 'price_range' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status_enum' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'priority' END], lambda x: x IS NOT NULL) AS e FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > -500) ON o_custkey = c_custkey) SELECT o_orderkey, array_to_string(e, ',') AS errors, CAST(len(e) AS INT) AS n_errors FROM e WHERE len(e) > 0",
    "atomicity_violations": f"WITH {OBS} SELECT obs_id, k * 6 AS error_m FROM obs WHERE NOT ((obs_id % 3 = 0 AND obs_id % 4 = 0) OR (obs_id % 3 <> 0 AND obs_id % 4 <> 0 AND k * 6 <= 500))",
    "harvest_status": f"WITH {OBS}, a AS (SELECT CAST(date_diff('day', day, DATE '2024-01-31') AS INT) AS age FROM obs) SELECT CASE WHEN age > 25 THEN 'EXPIRED' WHEN age > 20 THEN 'EXPIRING' ELSE 'AVAILABLE' END AS status, age, count(*) AS n FROM a GROUP BY 1, 2",
    "intake_split": f"WITH {OBS} SELECT obs_id, CASE WHEN kind IN ('view', 'click') THEN 'event' ELSE 'hold' END AS queue, CASE WHEN kind IN ('view', 'click') THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS at FROM obs",
    "review_crosswalk": f"WITH {OBS} SELECT CASE kind WHEN 'view' THEN 'reviewed' WHEN 'click' THEN 'needs_review' WHEN 'purchase' THEN 'accepted' ELSE 'unreviewed' END AS status, count(*) AS n FROM obs GROUP BY 1",
    "normalized_air_events": f"WITH {OBS}, a AS (SELECT *, coalesce(nullif(altitude_ft, 0), nullif(k, 0), 0) AS alt FROM obs) SELECT 'air_' || substr(sha256(aircraft || '|' || obs_id || '|' || alt), 1, 16) AS event_id, aircraft, alt AS altitude_ft, greatest(0.0, least(1.0, value / CAST(50.0 AS DOUBLE))) AS confidence FROM a",
    "string_sorted_page": "SELECT c_custkey, c_nationkey FROM customer ORDER BY coalesce(CAST(c_nationkey AS VARCHAR), '') DESC, c_custkey LIMIT 100",
    "worklist_top": f"WITH {OBS}, g AS (SELECT CAST(trunc(lat / CAST(0.02 AS DOUBLE)) AS INT) AS cell, kind, 3 * count(DISTINCT aircraft) + count(*) + 2 * count(DISTINCT day) AS score FROM obs GROUP BY 1, 2) SELECT *, CAST(row_number() OVER (ORDER BY score DESC, cell, kind) AS INT) AS rank FROM g QUALIFY rank <= 25",
    "queue_ranking": f"WITH {OBS}, w AS (SELECT aircraft, count(*) AS wave FROM obs GROUP BY 1), q AS (SELECT obs_id, corridor_id, wave, CASE WHEN day < '2024-01-05' THEN 1 WHEN wave >= 70 THEN 2 ELSE 3 END AS band FROM obs JOIN w USING (aircraft) WHERE kind = 'error') SELECT obs_id, corridor_id, band, CAST(row_number() OVER (PARTITION BY corridor_id ORDER BY band, wave DESC, obs_id) AS INT) AS rank FROM q",
    "heterogeneous_union": "SELECT c_custkey AS id, c_mktsegment AS segment, NULL AS name FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier",
    "card_fields": f"WITH {OBS}, {_CARD} SELECT obs_id, nullif(regexp_extract(card, '{C.REGISTRATION[0]}', 0), '') AS registration, TRY_CAST(replace(regexp_extract(card, '{C.SCAN_FEET}', 1), ',', '') AS BIGINT) AS altitude_ft, TRY_CAST(nullif(regexp_extract(card, '{C.SCAN_KNOTS}', 1), '') AS BIGINT) AS speed_kt, TRY_CAST(nullif(regexp_extract(card, '{C.SCAN_MPH}', 1), '') AS BIGINT) AS speed_mph, TRY_CAST(regexp_extract(card, '{C.HEADING}', 1) AS BIGINT) AS heading, CASE WHEN k % 3 = 0 THEN 'B407' WHEN k % 3 = 1 THEN 'R44' END AS aircraft_type FROM card JOIN obs USING (obs_id)",
    "tail_normalization": f"SELECT p_partkey, regexp_replace(upper(regexp_replace({_RAW}, '\\(.*?\\)', '', 'g')), '[^A-Z0-9-]', '', 'g') AS tail, regexp_matches('N' || p_partkey || 'AB', '^N[1-9]\\d{{0,2}}[A-HJ-NP-Z]{{2}}$') AS valid, {_FOLD.format(_RAW)} AS folded FROM part",
    "edit_distances": f"SELECT p_partkey, CAST(levenshtein(p_name, p_type) AS INT) AS distance, {_FOLD.format('p_name')} = {_FOLD.format('p_type')} AS same FROM part",
    "unusual_patterns": f"WITH {OBS} SELECT obs_id, 'unusual_time' AS type FROM obs WHERE kind = 'error' AND NOT hour(ts) BETWEEN 7 AND 18 UNION ALL SELECT obs_id, 'unusual_duration' FROM obs WHERE kind = 'view' AND altitude_ft / CAST(60 AS DOUBLE) > 150 UNION ALL SELECT obs_id, 'potential_clustering_error' FROM obs WHERE k > 95",
    "keyword_classes": "SELECT CASE WHEN regexp_matches(lower(url), 'spam|pills') THEN 'spam' WHEN contains(lower(url), 'blog') THEN 'blog' WHEN contains(lower(url), '//m.') THEN 'mobile' ELSE 'other' END AS kind, count(*) AS n FROM pages GROUP BY 1",
    "path_shapes": f"WITH {OBS} SELECT aircraft, day, CASE WHEN count(*) < 2 THEN 'single' WHEN min(speed_mph) < 10 AND max(speed_mph) > 150 THEN 'mixed' WHEN min(speed_mph) < 10 THEN 'hover' WHEN max(speed_mph) > 150 THEN 'transit' ELSE 'cruise' END AS shape FROM obs GROUP BY 1, 2",
    "content_ids": "SELECT doc_id, 'doc_' || substr(sha256(lang || '|' || source || '|' || n_chars), 1, 24) AS content_id, substr(sha1(text), 1, 16) AS sha1_16 FROM documents",
    "presence_vector": f"WITH {OBS}, s AS (SELECT obs_id, (CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 <> 0 THEN 1 ELSE 0 END + CASE WHEN trim(kind) <> '' THEN 1 ELSE 0 END) / CAST(4.0 AS DOUBLE) AS coverage FROM obs) SELECT *, CASE WHEN coverage >= 0.75 THEN 1 WHEN coverage >= 0.5 THEN 2 WHEN coverage >= 0.25 THEN 3 ELSE 4 END AS tier FROM s",
    "slippy_tiles": f"WITH {OBS} SELECT CAST(floor((lon + 180.0) / 360.0 * 4096.0) AS BIGINT) AS x, CAST(floor((1.0 - ln(tan(radians(lat)) + 1.0 / cos(radians(lat))) / pi()) / 2.0 * 4096.0) AS BIGINT) AS y, count(*) AS n FROM obs GROUP BY 1, 2",
    "distance_units": f"WITH {OBS} SELECT obs_id, round({hav_sql(*_TO, 6371000.0)}, 6) AS m, round({hav_sql(*_TO, 6371.0088)}, 6) AS km, round({hav_sql(*_TO, 3440.065)}, 6) AS nm, round(speed_mph * CAST(1.15078 AS DOUBLE), 6) AS mph FROM obs",
}
