"""Queries: baselines, anomalies, flight fusion, waves, sessions, change and forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import windows as W
from ..operators.cuts import row_numbers
from ..operators.joins import last_wins
from .mapping import OBS, observations

CUT = "2024-01-21"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.select("corridor_id", F.col("kind").alias("domain"), F.lit(1.0).alias("event_count"), "confidence", "ts")


def historical_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.baselines(_records(spark, sf_dir).where(F.col("ts") < CUT))
    return b.withColumn("mean_confidence", F.round("mean_confidence", 6))


def baseline_anomaly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir)
    current = rows.where(F.col("ts") >= CUT).groupBy("corridor_id", "domain").agg(
        F.sum("event_count").alias("current_count"), F.round(F.avg("confidence"), 6).alias("confidence")
    )
    return A.anomalies(current, A.baselines(rows.where(F.col("ts") < CUT)))


_ANOM = f"""{OBS}, h AS (SELECT corridor_id, kind AS domain, CAST(count(*) AS DOUBLE) AS historical_count FROM obs WHERE ts < '{CUT}' GROUP BY 1, 2),
c AS (SELECT corridor_id, kind AS domain, CAST(count(*) AS DOUBLE) AS current_count, round(avg(confidence), 6) AS confidence FROM obs WHERE ts >= '{CUT}' GROUP BY 1, 2),
s AS (SELECT c.*, coalesce(historical_count, 0.0) AS historical_count, CASE WHEN coalesce(historical_count, 0) <= 0 THEN 1.0 ELSE current_count / historical_count END AS ratio FROM c LEFT JOIN h USING (corridor_id, domain)),
a AS (SELECT *, round(CAST(0.65 AS DOUBLE) * greatest(0.0, least(1.0, abs(ratio - 1.0))) + CAST(0.35 AS DOUBLE) * greatest(0.0, least(1.0, confidence)), 3) AS anomaly_score FROM s)
, scored AS (SELECT corridor_id, domain, current_count, historical_count, confidence, anomaly_score,
CASE WHEN anomaly_score >= 0.8 THEN 'high_review' WHEN anomaly_score >= 0.6 THEN 'moderate_review' ELSE 'low_review' END AS review_band FROM a WHERE anomaly_score >= 0.4)"""


def anomaly_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_anomaly_scores(spark, sf_dir).groupBy("review_band", "corridor_id").agg(F.count("*").alias("n"))


def wave_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    minutes = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 60e6
    waves = o.groupBy("aircraft").agg(
        F.count("*").alias("obs_count"), F.min("ts").alias("earliest"), F.max("ts").alias("latest"),
        F.round(minutes, 6).alias("duration_minutes"), F.round(F.avg("confidence"), 6).alias("mean_confidence"),
        F.bool_and(F.col("k").isNotNull()).alias("all_parsed"),
    )
    numbered = row_numbers(waves, [F.col("aircraft")], "_i")
    return numbered.withColumn("wave_id", F.format_string("wave_%06d", F.col("_i") + 1)).drop("_i")


def flight_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    mode = A.mode_first(o, ["aircraft"], "kind", "obs_id").withColumnRenamed("kind", "consensus_kind").drop("n")
    rolled = o.groupBy("aircraft").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.max("altitude_ft").alias("max_altitude_ft"),
        F.round(F.avg("speed_mph"), 6).alias("avg_speed_mph"), F.count("*").alias("points"),
    )
    return rolled.join(mode, "aircraft")


def fused_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of each track in order, a row for each, with the altitude at the track's start and end."""
    o = observations(spark, sf_dir)
    track = Window.partitionBy("aircraft")
    at = track.orderBy("ts", "obs_id")
    ends = [f("altitude_ft", F.struct("ts", "obs_id")).over(track) for f in (F.min_by, F.max_by)]
    return o.select("aircraft", F.row_number().over(at).alias("seq"), "obs_id", ends[0].alias("first_altitude_ft"), ends[1].alias("last_altitude_ft"))


def session_polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polyline of each flight, or its ends where it has fewer than three points."""
    s = W.sessions(observations(spark, sf_dir), ["aircraft", "day"], "ts", "obs_id", 240)
    # a flight's points: a gap of four hours ends it
    points = F.array_sort(F.collect_list(F.struct("ts", "obs_id", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat"))))
    p = s.groupBy("aircraft", "day", "session").agg(points.alias("p"))
    whole = F.transform("p", lambda x: F.format_string("%.4f %.4f", x["lon"], x["lat"]))
    n = F.size("p")
    ends = F.array(F.element_at(whole, 1), F.element_at(whole, -1))
    return p.select("aircraft", "day", "session", F.when(n >= 3, "track").otherwise("endpoints").alias("basis"), F.array_join(F.when(n >= 3, whole).otherwise(ends), ",").alias("line"))


def group_best_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners and losers of each group, with the group's ordinal, the row's rank and how many duplicates it has.

    A group of more than one is ranked by five keys; groups are numbered in order.
    """
    o = observations(spark, sf_dir)
    group = Window.partitionBy("aircraft", "day", "kind")
    order = (F.desc("confidence"), F.desc("altitude_ft"), F.desc("speed_mph"), F.desc("value"), F.col("obs_id"))
    ranked = o.withColumns({"r": F.row_number().over(group.orderBy(*order)), "duplicate_count": F.count("*").over(group) - 1})
    groups = row_numbers(o.select("aircraft", "day", "kind").distinct(), [F.col(c) for c in ("aircraft", "day", "kind")], "_g")
    met = ranked.join(groups, ["aircraft", "day", "kind"])
    return met.select(
        (F.col("_g") + 1).alias("group_no"), "aircraft", "day", "kind", "obs_id", F.col("r").alias("group_rank"), "duplicate_count",
        F.when(F.col("r") == 1, "winner").otherwise("duplicate").alias("outcome"),
    )


def priority_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    sources = [
        o.where("kind = 'error'").select("aircraft", F.lit("error").alias("reason"), F.lit(1).alias("rank"), "obs_id"),
        o.where("confidence < 0.2").select("aircraft", F.lit("low_confidence").alias("reason"), F.lit(2).alias("rank"), "obs_id"),
        o.where("speed_mph > 200").select("aircraft", F.lit("speed").alias("reason"), F.lit(3).alias("rank"), "obs_id"),
    ]
    both = sources[0].unionByName(sources[1]).unionByName(sources[2])
    return last_wins(both, ["aircraft"], [F.col("rank"), F.col("obs_id")]).select("aircraft", "reason", "obs_id")


def flight_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = W.sessions(observations(spark, sf_dir), ["aircraft", "day"], "ts", "obs_id", 60)
    return s.groupBy("aircraft", "day", "session").agg(F.count("*").alias("n"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


_SESS = f"""{OBS}, g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 3600000000 THEN 1 ELSE 0 END AS n0
 FROM obs WINDOW w AS (PARTITION BY aircraft, day ORDER BY ts, obs_id)),
 s AS (SELECT *, sum(n0) OVER (PARTITION BY aircraft, day ORDER BY ts, obs_id) AS session FROM g)"""


def recurring_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of at least two different kinds in a row that recur."""
    s = W.sessions(observations(spark, sf_dir), ["aircraft", "day"], "ts", "obs_id", 480)
    before = F.lag("kind").over(Window.partitionBy("aircraft", "day", "session").orderBy("ts", "obs_id"))
    # only the changes of a session are gathered, which make up its name
    changes = s.withColumn("_before", before).where("_before is null or _before <> kind")
    kept = F.transform(F.array_sort(F.collect_list(F.struct("ts", "obs_id", "kind"))), lambda x: x["kind"])
    routes = changes.groupBy("aircraft", "day", "session").agg(kept.alias("q"))
    named = routes.select(F.array_join("q", ">").alias("route"), F.size("q").alias("stops"), "aircraft")
    return named.where("stops >= 2").groupBy("route").agg(F.count("*").alias("n"), F.countDistinct("aircraft").alias("aircraft")).where("n >= 2")


def pair_physics_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.pair_checks(observations(spark, sf_dir), "aircraft", "ts", "obs_id", "altitude_ft", "speed_mph")


def track_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    at = F.struct("ts", "obs_id")
    return o.groupBy("aircraft", "day").agg(
        F.min_by("obs_id", at).alias("first_obs"), F.max_by("obs_id", at).alias("last_obs"),
        F.min_by("altitude_ft", at).alias("first_altitude"), F.max_by("altitude_ft", at).alias("last_altitude"),
    )


def weekly_change_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).withColumn("week", F.floor((F.dayofmonth("day") - 1) / 7).cast("int"))
    n = o.groupBy("aircraft", "week").agg(F.count("*").alias("n"))
    c = W.monthly_changes(n, "aircraft", "week", "n")
    return c.select("aircraft", "week", "n", "delta", F.round("z", 6).alias("z"), "flag")


def short_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate by aircraft, weekday and three-hour bucket over the last three weeks."""
    o = observations(spark, sf_dir)
    last = o.agg(F.max("day").alias("last_day"))
    recent = o.join(F.broadcast(last)).where(F.col("day") > F.date_sub("last_day", 21))
    top = recent.groupBy("aircraft").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "aircraft").limit(20).select("aircraft")
    cells = recent.join(top, "aircraft", "left_semi").groupBy("aircraft", F.dayofweek("day").alias("dow"), F.floor(F.hour("ts") / 3).cast("int").alias("bucket"))
    rates = cells.agg((F.count("*") / F.lit(3.0)).alias("expected")).where("expected >= 0.25")
    days = last.select(F.explode(F.sequence(F.date_add("last_day", 1), F.date_add("last_day", 7))).alias("forecast_day"))
    days = days.withColumn("dow", F.dayofweek("forecast_day"))
    return rates.join(F.broadcast(days), "dow").select("aircraft", "forecast_day", "bucket", F.round("expected", 6).alias("expected"))


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = W.batch_plan(observations(spark, sf_dir).select("obs_id", "kind"), [F.col("kind"), F.col("obs_id")], 100)
    return p.select("obs_id", "batch_index", "position")


def gap_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of a source that begin before the one before them ends."""
    o = observations(spark, sf_dir)
    g = o.select("aircraft", "obs_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("make_dt_interval(0, cast(altitude_ft % 12 as int), 0, 0)")).alias("end_ts"))
    order = Window.partitionBy("aircraft").orderBy("start_ts", "end_ts", "obs_id")
    return g.withColumn("before_end", F.lag("end_ts").over(order)).where("before_end > start_ts").select("aircraft", "obs_id", "start_ts", "before_end")


def sampled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most five points of a track, evenly down-sampled by index."""
    o = observations(spark, sf_dir)
    track = Window.partitionBy("aircraft")
    p = o.select("aircraft", "obs_id", (F.row_number().over(track.orderBy("ts", "obs_id")) - 1).alias("i"), F.count("*").over(track).alias("n"))
    chosen = (F.col("n") <= 5) | F.exists(F.sequence(F.lit(0), F.lit(4)), lambda j: F.floor(j * F.col("n") / 5) == F.col("i"))
    # five ids at most for each track
    return p.where(chosen).groupBy("aircraft").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "obs_id"))), lambda x: x["obs_id"].cast("string")), ",").alias("sample"))


def replay_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of two sensors and their gaps by (time, id), without interpolation."""
    o = observations(spark, sf_dir)
    a = o.where("kind = 'view'").select(F.col("ts").alias("event_ts"), F.concat(F.lit("a"), "obs_id").alias("item"), F.lit("adsb").alias("sensor"))
    b = o.where("kind = 'click'").select(F.col("ts").alias("event_ts"), F.concat(F.lit("b"), "obs_id").alias("item"), F.lit("screen").alias("sensor"))
    order = Window.partitionBy("sensor").orderBy("event_ts", "item")
    both = a.unionByName(b).withColumn("gap_s", F.unix_micros(F.col("event_ts").cast("timestamp")) - F.unix_micros(F.lag("event_ts").over(order).cast("timestamp")))
    return both.select("event_ts", "item", "sensor", (F.coalesce("gap_s", F.lit(0)) > 7200000000).alias("after_gap"))


def running_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation's largest value so far in its corridor, by confidence."""
    o = observations(spark, sf_dir).select("obs_id", "corridor_id", "value", "confidence")
    return W.running_max(o, "corridor_id", "value", [F.col("confidence"), F.col("obs_id")], "running_value").select("obs_id", "running_value")


QUERIES = {f.__name__: f for f in (historical_baselines, baseline_anomaly_scores, anomaly_band_counts, wave_rollup, flight_fusion, fused_points, session_polylines, group_best_dedup, priority_review_queue, flight_sessions, recurring_routes, pair_physics_checks, track_endpoints, weekly_change_flags, short_forecast, batch_plan, gap_overlaps, sampled_points, replay_timeline, running_calibration)}

ORACLE = {
    "historical_baselines": f"WITH {OBS} SELECT corridor_id, kind AS domain, CAST(count(*) AS DOUBLE) AS historical_count, round(avg(confidence), 6) AS mean_confidence, CAST(0.0 AS DOUBLE) AS count_stddev FROM obs WHERE ts < '{CUT}' GROUP BY 1, 2",
    "baseline_anomaly_scores": f"WITH {_ANOM} SELECT * FROM scored",
    "anomaly_band_counts": f"WITH {_ANOM} SELECT review_band, corridor_id, count(*) AS n FROM scored GROUP BY 1, 2",
    "wave_rollup": f"WITH {OBS}, w AS (SELECT aircraft, count(*) AS obs_count, min(ts) AS earliest, max(ts) AS latest, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 60e6, 6) AS duration_minutes, round(avg(confidence), 6) AS mean_confidence, bool_and(k IS NOT NULL) AS all_parsed FROM obs GROUP BY 1) SELECT *, 'wave_' || lpad(CAST(row_number() OVER (ORDER BY aircraft) AS VARCHAR), 6, '0') AS wave_id FROM w",
    "flight_fusion": f"WITH {OBS}, c AS (SELECT aircraft, kind, count(*) AS n, min(obs_id) AS s FROM obs GROUP BY 1, 2), m AS (SELECT aircraft, kind AS consensus_kind FROM c QUALIFY row_number() OVER (PARTITION BY aircraft ORDER BY n DESC, s) = 1) SELECT aircraft, min(ts) AS first_ts, max(ts) AS last_ts, max(altitude_ft) AS max_altitude_ft, round(avg(speed_mph), 6) AS avg_speed_mph, count(*) AS points, any_value(consensus_kind) AS consensus_kind FROM obs JOIN m USING (aircraft) GROUP BY aircraft",
    "fused_points": f"WITH {OBS} SELECT aircraft, CAST(row_number() OVER w AS INT) AS seq, obs_id, first_value(altitude_ft) OVER (PARTITION BY aircraft ORDER BY ts, obs_id) AS first_altitude_ft, first_value(altitude_ft) OVER (PARTITION BY aircraft ORDER BY ts DESC, obs_id DESC) AS last_altitude_ft FROM obs WINDOW w AS (PARTITION BY aircraft ORDER BY ts, obs_id)",
    "session_polylines": f"WITH {_SESS.replace('3600000000', '14400000000')}, p AS (SELECT aircraft, day, CAST(session AS BIGINT) AS session, count(*) AS n, list(printf('%.4f', round(lon, 4)) || ' ' || printf('%.4f', round(lat, 4)) ORDER BY ts, obs_id) AS p FROM s GROUP BY 1, 2, 3) SELECT aircraft, day, session, CASE WHEN n >= 3 THEN 'track' ELSE 'endpoints' END AS basis, CASE WHEN n >= 3 THEN array_to_string(p, ',') ELSE p[1] || ',' || p[-1] END AS line FROM p",
    "group_best_dedup": f"WITH {OBS}, r AS (SELECT *, row_number() OVER (PARTITION BY aircraft, day, kind ORDER BY confidence DESC, altitude_ft DESC, speed_mph DESC, value DESC, obs_id) AS r FROM obs) SELECT dense_rank() OVER (ORDER BY aircraft, day, kind) AS group_no, aircraft, day, kind, obs_id, r AS group_rank, count(*) OVER (PARTITION BY aircraft, day, kind) - 1 AS duplicate_count, CASE WHEN r = 1 THEN 'winner' ELSE 'duplicate' END AS outcome FROM r",
    "priority_review_queue": f"WITH {OBS}, u AS (SELECT aircraft, 'error' AS reason, 1 AS r, obs_id FROM obs WHERE kind = 'error' UNION ALL SELECT aircraft, 'low_confidence', 2, obs_id FROM obs WHERE confidence < 0.2 UNION ALL SELECT aircraft, 'speed', 3, obs_id FROM obs WHERE speed_mph > 200) SELECT aircraft, reason, obs_id FROM u QUALIFY row_number() OVER (PARTITION BY aircraft ORDER BY r, obs_id) = 1",
    "flight_sessions": f"WITH {_SESS} SELECT aircraft, day, CAST(session AS BIGINT) AS session, count(*) AS n, min(ts) AS start_ts, max(ts) AS end_ts FROM s GROUP BY 1, 2, 3",
    "recurring_routes": f"WITH {_SESS.replace('3600000000', '28800000000')}, t AS (SELECT aircraft, day, session, kind, ts, obs_id, lag(kind) OVER (PARTITION BY aircraft, day, session ORDER BY ts, obs_id) AS p FROM s), r AS (SELECT aircraft, day, session, string_agg(kind, '>' ORDER BY ts, obs_id) AS route, count(*) AS stops FROM t WHERE p IS NULL OR p <> kind GROUP BY 1, 2, 3) SELECT route, count(*) AS n, count(DISTINCT aircraft) AS aircraft FROM r WHERE stops >= 2 GROUP BY 1 HAVING count(*) >= 2",
    "pair_physics_checks": f"WITH {OBS}, p AS (SELECT aircraft, row_number() OVER w > 1 AS pair, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 60e6 AS minutes, altitude_ft - lag(altitude_ft) OVER w AS climb_ft, speed_mph, lag(speed_mph) OVER w AS ps FROM obs WINDOW w AS (PARTITION BY aircraft ORDER BY ts, obs_id)) SELECT aircraft, count(*) AS observations, CAST(sum(CASE WHEN pair AND minutes < 0 THEN 1 ELSE 0 END) AS BIGINT) AS backward, CAST(sum(CASE WHEN pair AND minutes > 0 AND abs(climb_ft) / minutes > 1500 THEN 1 ELSE 0 END) AS BIGINT) AS climb, CAST(sum(CASE WHEN pair THEN CAST(NOT speed_mph BETWEEN 0 AND 180 AS INT) + CAST(NOT ps BETWEEN 0 AND 180 AS INT) ELSE 0 END) AS BIGINT) AS speed FROM p GROUP BY 1",
    "track_endpoints": f"WITH {OBS} SELECT aircraft, day, first(obs_id ORDER BY ts, obs_id) AS first_obs, last(obs_id ORDER BY ts, obs_id) AS last_obs, first(altitude_ft ORDER BY ts, obs_id) AS first_altitude, last(altitude_ft ORDER BY ts, obs_id) AS last_altitude FROM obs GROUP BY 1, 2",
    "weekly_change_flags": f"WITH {OBS}, c AS (SELECT aircraft, CAST(floor((day(day) - 1) / 7) AS INT) AS week, count(*) AS n FROM obs GROUP BY 1, 2), g AS (SELECT a.aircraft, w.week, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT aircraft FROM c) a CROSS JOIN (SELECT DISTINCT week FROM c) w LEFT JOIN c ON c.aircraft = a.aircraft AND c.week = w.week), z AS (SELECT *, lag(n) OVER o AS prior, sum(n) OVER (PARTITION BY aircraft ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen, (n - avg(n) OVER p) / CASE WHEN stddev_pop(n) OVER p = 0 THEN 1.0 ELSE stddev_pop(n) OVER p END AS z FROM g WINDOW o AS (PARTITION BY aircraft ORDER BY week), p AS (PARTITION BY aircraft)) SELECT aircraft, week, n, n - prior AS delta, round(z, 6) AS z, CASE WHEN n = 0 AND prior > 0 THEN 'vanished' WHEN n > 0 AND prior = 0 AND seen = 0 THEN 'debut' WHEN n > 0 AND prior = 0 THEN 'returned' WHEN z >= 1.5 THEN 'surge' WHEN z <= -1.5 THEN 'decline' ELSE 'stable' END AS flag FROM z",
    "short_forecast": f"WITH {OBS}, l AS (SELECT max(day) AS d FROM obs), r AS (SELECT obs.* FROM obs, l WHERE day > d - 21), t AS (SELECT aircraft FROM r GROUP BY 1 ORDER BY count(*) DESC, aircraft LIMIT 20), c AS (SELECT aircraft, dayofweek(day) + 1 AS dow, CAST(floor(hour(ts) / 3) AS INT) AS bucket, count(*) / CAST(3.0 AS DOUBLE) AS expected FROM r WHERE aircraft IN (SELECT aircraft FROM t) GROUP BY 1, 2, 3), d AS (SELECT CAST(d + i AS DATE) AS forecast_day, dayofweek(CAST(d + i AS DATE)) + 1 AS dow FROM l, (SELECT CAST(unnest(range(1, 8)) AS INT) AS i)) SELECT aircraft, forecast_day, bucket, round(expected, 6) AS expected FROM c JOIN d USING (dow) WHERE expected >= 0.25",
    "batch_plan": f"WITH {OBS}, n AS (SELECT obs_id, row_number() OVER (ORDER BY kind, obs_id) - 1 AS i FROM obs) SELECT obs_id, i // 100 AS batch_index, i % 100 AS position FROM n",
    "gap_overlaps": f"WITH {OBS}, g AS (SELECT aircraft, obs_id, ts AS start_ts, ts + to_hours(CAST(altitude_ft % 12 AS INT)) AS end_ts FROM obs), p AS (SELECT *, lag(end_ts) OVER (PARTITION BY aircraft ORDER BY start_ts, end_ts, obs_id) AS before_end FROM g) SELECT aircraft, obs_id, start_ts, before_end FROM p WHERE before_end > start_ts",
    "sampled_points": f"WITH {OBS}, p AS (SELECT aircraft, list(obs_id ORDER BY ts, obs_id) AS p FROM obs GROUP BY 1) SELECT aircraft, CASE WHEN len(p) <= 5 THEN array_to_string(p, ',') ELSE array_to_string(list_transform(range(0, 5), lambda i: p[CAST(i * len(p) // 5 AS INT) + 1]), ',') END AS sample FROM p",
    "replay_timeline": f"WITH {OBS}, u AS (SELECT ts AS event_ts, 'a' || obs_id AS item, 'adsb' AS sensor FROM obs WHERE kind = 'view' UNION ALL SELECT ts, 'b' || obs_id, 'screen' FROM obs WHERE kind = 'click') SELECT event_ts, item, sensor, coalesce(epoch_us(event_ts) - epoch_us(lag(event_ts) OVER (PARTITION BY sensor ORDER BY event_ts, item)), 0) > 7200000000 AS after_gap FROM u",
    "running_calibration": f"WITH {OBS} SELECT obs_id, max(value) OVER (PARTITION BY corridor_id ORDER BY confidence, obs_id ROWS UNBOUNDED PRECEDING) AS running_value FROM obs",
}


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming session operator on a batch; the same sessions as by gaps."""
    from ..streaming import live

    return live.sessions(observations(spark, sf_dir).select("aircraft", "ts")).select(
        "aircraft", "day", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"), F.col("end_ts").cast("timestamp_ntz").alias("end_ts"), "n"
    )


def hourly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming import live

    w = live.tumbling(observations(spark, sf_dir).select("ts", "kind"), "ts", "3 hours")
    return w.select(F.col("start_ts").cast("timestamp_ntz").alias("start_ts"), "kind", "n")


QUERIES |= {"session_windows": session_windows, "hourly_windows": hourly_windows}
ORACLE |= {
    "session_windows": f"WITH {_SESS} SELECT aircraft, day, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n FROM s GROUP BY aircraft, day, session",
    "hourly_windows": f"WITH {OBS} SELECT time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2000-01-01') AS start_ts, kind, count(*) AS n FROM obs GROUP BY 1, 2",
}
