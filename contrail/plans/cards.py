"""Queries: fields read from the texts of cards, panels, regions, logs and file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cards as C
from .mapping import OBS, observations

# Texts are built from observations by SQL that both engines read; what is then read from them is written twice.
_WEEK = "CASE obs_id % 3 WHEN 0 THEN 'Mon' WHEN 1 THEN 'tue' ELSE 'Sun' END || ', ' || CASE obs_id % 4 WHEN 0 THEN 'Jan' WHEN 1 THEN 'Mar' WHEN 2 THEN 'Dec' ELSE 'Foo' END || ' ' || CAST(1 + obs_id % 28 AS STRING) || ', 2024'"
_IMAGE = f"""CASE obs_id % 4 WHEN 0 THEN 'FlightRadar24  ' WHEN 1 THEN 'flighttadar ' WHEN 2 THEN 'Map' ELSE '' END || ' ' ||
 CASE obs_id % 5 WHEN 0 THEN 'CG' || CAST(6000 + k AS STRING) || ' (BQN) United States - Coast Guard BQN ' WHEN 1 THEN aircraft || 'AB (X1) Private owner SJU' WHEN 2 THEN 'EJA33 NetJets' WHEN 3 THEN 'no label' ELSE 'ABC (N/A) Acme Air. N/A' END || '   ' ||
 CASE k % 6 WHEN 0 THEN 'Bell 407' WHEN 1 THEN 'Robinson R44 Raven II' WHEN 2 THEN 'sikorsky MH60T jayhawk' WHEN 3 THEN 'Airbus Helicopters H145' WHEN 4 THEN 'Lockheed C130T Hercules' ELSE 'Glider' END ||
 CASE k % 4 WHEN 0 THEN ' REG. ' || aircraft || 'AB' WHEN 1 THEN ' REG NO' WHEN 2 THEN ' reg  N12-X' ELSE '' END ||
 CASE k % 3 WHEN 0 THEN ' BAROMETRIC ALT. about 1,' || CAST(100 + k AS STRING) || ' ft' WHEN 1 THEN ' ' || CAST(altitude_ft AS STRING) || ' ft GROUND SPEED x' ELSE '' END ||
 CASE k % 5 WHEN 0 THEN ' GROUND SPEED: 12' || CAST(k % 10 AS STRING) || ' mph' WHEN 1 THEN ' 88 mph' ELSE '' END ||
 CASE obs_id % 7 WHEN 0 THEN ' Departed 00:35 ago' WHEN 1 THEN ' Arrived01:05 ago' WHEN 2 THEN ' Arriving in 00:20' WHEN 3 THEN ' ...parted 2:10 ago PSE' ELSE ' MAZ EIS' END ||
 CASE WHEN obs_id % 3 <> 2 THEN ' ' || {_WEEK} || ' | 10:' || CAST(10 + k % 50 AS STRING) || CASE WHEN k % 2 = 0 THEN ' AM UTC -04:00' ELSE '' END ELSE '' END"""
_CARD = """CASE obs_id % 5 WHEN 0 THEN 'Reg ' || aircraft || 'X' WHEN 1 THEN 'C-FABC' WHEN 2 THEN 'EC-ABC' WHEN 3 THEN 'call CGX12B now' ELSE 'nothing here' END || ' | ' ||
 CASE k % 3 WHEN 0 THEN '12,' || CAST(100 + k AS STRING) || ' FT' WHEN 1 THEN CAST(altitude_ft AS STRING) || 'ft' ELSE 'ft' END || ' ' || CAST(CAST(floor(speed_mph) AS INT) AS STRING) || CASE k % 4 WHEN 0 THEN ' kt' WHEN 1 THEN 'mph' WHEN 2 THEN ' MPH and 7 kt' ELSE ' km' END ||
 ' Heading: ' || CAST(altitude_ft % 500 AS STRING) || CASE k % 5 WHEN 0 THEN ' bell 407' WHEN 1 THEN ' AS-350' WHEN 2 THEN ' Robinson' WHEN 3 THEN ' B407 R44' ELSE ' jet' END ||
 CASE k % 6 WHEN 0 THEN ' Coast guard' WHEN 1 THEN ' US air force' WHEN 2 THEN ' aircargo' WHEN 3 THEN ' Municipio de Caguas' ELSE '' END ||
 CASE obs_id % 4 WHEN 0 THEN ' XXX SJU MIA' WHEN 1 THEN ' SJU SJU BQN JFK' WHEN 2 THEN ' ABC DEF' ELSE ' STT STX' END ||
 CASE obs_id % 3 WHEN 0 THEN ' Departed 01:' || CAST(10 + k % 50 AS STRING) || ' ago' WHEN 1 THEN ' arriving in 00:45' ELSE '' END || ' SERIAL: ' || CASE WHEN k % 2 = 0 THEN 'AB-1234' ELSE 'xyz' END ||
 ' 10:30 AM 10:30am ' || CASE WHEN k % 3 = 0 THEN '11:00 PM 9:15 am' ELSE '' END || ' C172 UTC -04:00'"""
_KIND = "CASE obs_id % 6 WHEN 0 THEN 'Callsign' WHEN 1 THEN 'altitude' WHEN 2 THEN 'speed' WHEN 3 THEN 'route' WHEN 4 THEN 'panel' END"
_STATUS = "CASE WHEN k % 11 = 0 THEN 'failed' ELSE 'ok' END"
_CHARS = "k % 60"


def _texts(spark: SparkSession, sf_dir: str, **made: str) -> DataFrame:
    return observations(spark, sf_dir).selectExpr("obs_id", *[f"{v} AS {k}" for k, v in made.items()])


def _with(**made: str) -> str:
    return f"WITH {OBS}, t AS (SELECT obs_id, {', '.join(f'{v} AS {k}' for k, v in made.items())} FROM obs)"


def _first(text: str, *patterns: str, group: int = 1) -> str:
    """SQL for the first pattern's group that is met."""
    each = [f"nullif(trim(regexp_extract({text}, '{p}', {group})), '')" for p in patterns]
    return each[0] if len(each) == 1 else f"coalesce({', '.join(each)})"


def _score(parts: dict[str, float]) -> str:
    return "round(least(CAST(1.0 AS DOUBLE), " + " + ".join(f"CASE WHEN {c} THEN CAST({w} AS DOUBLE) ELSE 0 END" for c, w in parts.items()) + "), 2)"


_TYPE = _first("x", *[rf"(?i)\b({a})" for a in C.AIRCRAFT])
_REG = f"CASE WHEN {_first('x', C.REG)} NOT IN ('N', 'NO', 'N/A') THEN {_first('x', C.REG)} END"
_SQUEEZE = "trim(regexp_replace(coalesce(body, ''), '\\s+', ' ', 'g'))"
_CODE = lambda i: f"regexp_extract_all(x, '{C.CODES}', 1)[{i}]"


def whole_image_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of whole images with additive confidence and review status."""
    t = _texts(spark, sf_dir, body=_IMAGE, chars=_CHARS)
    return C.whole_images(t, "body", "chars").drop("body", "chars")


def region_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of image regions, each kind with its own, and the status ladder."""
    t = _texts(spark, sf_dir, body=_IMAGE, chars=_CHARS, kind=_KIND, ocr=_STATUS)
    return C.regions(t, "body", "kind", "chars", "ocr").drop("body", "kind", "chars", "ocr")


def scanned_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft fields of any card text: registrations of three forms, else callsigns; miles an hour as knots."""
    t = _texts(spark, sf_dir, body=_CARD)
    return t.select("obs_id", *[c.alias(n) for n, c in C.scanned(F.col("body")).items()])


def side_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of known codes, minutes, heading, serial and the hours of the time line."""
    t = _texts(spark, sf_dir, body=_CARD)
    return t.select("obs_id", *[c.alias(n) for n, c in C.mined(F.col("body")).items()])


def kit_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packaged reader's fields, one row for each that is found."""
    t = _texts(spark, sf_dir, body=_CARD)
    found = t.select("obs_id", *[c.alias(n) for n, c in C.kit_fields(F.col("body")).items()])
    long = found.unpivot("obs_id", list(C.KIT), "field", "value").where("value is not null")
    return long.withColumn("status", F.lit("screen_derived_unverified"))


_DATE = f"CASE k % 3 WHEN 0 THEN {_WEEK} WHEN 1 THEN '2024-02-' || CAST(10 + k % 25 AS STRING) ELSE 'Feb 3, 2024' END"
_TIME = "CASE obs_id % 5 WHEN 0 THEN '10:' || CAST(10 + k % 50 AS STRING) || ' AM' WHEN 1 THEN '23:05' WHEN 2 THEN '7:08:09' WHEN 3 THEN '' ELSE '12:30 pm' END"


def playback_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and times in any of their forms; a date that is none gives null."""
    t = _texts(spark, sf_dir, d=_DATE, t=_TIME)
    return t.select("obs_id", C.playback_time(F.col("d"), F.col("t")).alias("at"))


_FILE = "CASE k % 4 WHEN 0 THEN 'Screenshot_202403' || CAST(10 + obs_id % 19 AS STRING) || '-101112.png' WHEN 1 THEN 'IMG 2024-03-05 08-09.jpg' WHEN 2 THEN 'x.png' ELSE '20241340_101010.png' END"
_BAR = "CASE obs_id % 4 WHEN 0 THEN 'Mon, Mar 4, 2024 | 10' WHEN 1 THEN 'december 25, 2024' WHEN 2 THEN 'Feb 31, 2024' END"


def flight_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time in a file's name and the flight's true date: the replay bar's if it is not after the capture."""
    t = _texts(spark, sf_dir, name=_FILE, bar=_BAR)
    day, replay = C.flight_date(F.col("name"), F.col("bar"))
    return t.select("obs_id", C.file_time(F.col("name")).alias("captured"), day.alias("flight_date"), replay.alias("is_replay"))


_EPOCH = "CASE obs_id % 3 WHEN 0 THEN '2023-1' || CAST(k % 5 AS STRING) || '-07' WHEN 1 THEN '2024-0' || CAST(k % 10 AS STRING) ELSE 'unknown' END"


def epoch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two epochs relate by their months: the same, adjacent, apart, or unknown."""
    t = _texts(spark, sf_dir, a=_EPOCH, b="'2024-01-31'")
    i, j = C.month_index(F.col("a")), C.month_index(F.col("b"))
    apart = F.abs(i - j)
    kind = F.when(apart.isNull(), "unknown").when(apart == 0, "same_epoch").when(apart == 1, "adjacent").otherwise("cross_epoch")
    return t.select("obs_id", i.alias("month_index"), kind.alias("pair_class"))


def utc_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in UTC to the second with a Z: an offset is applied, a time without one is UTC, text that is none gives null."""
    t = _texts(spark, sf_dir, raw="CASE obs_id % 4 WHEN 0 THEN '2024-01-08T10:35:00-04:00' WHEN 1 THEN '2024-01-08 10:35:07' WHEN 2 THEN '2024-02-30T01:00:00Z' ELSE '2024-01-08T23:00:00+05:30' END")
    return t.select("obs_id", F.date_format(F.col("raw").try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"))


_TAIL = "CASE obs_id % 6 WHEN 0 THEN 'n ' || CAST(k AS STRING) || 'ab' WHEN 1 THEN '****' WHEN 2 THEN 'Unknown' WHEN 3 THEN ' C-FXYZ ' WHEN 4 THEN '' ELSE aircraft END"


def masked_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tails that are masked, that look like one, and other text."""
    t = _texts(spark, sf_dir, tail=_TAIL)
    return t.select("obs_id", *[c.alias(n) for n, c in C.masked_identity(F.col("tail")).items()])


_LOG = "CASE obs_id % 9 WHEN 0 THEN 'Noon' WHEN 5 THEN ' am' WHEN 6 THEN 'PM' WHEN 7 THEN 'Midday' WHEN 8 THEN 'evening' WHEN 1 THEN '9:05' WHEN 2 THEN ' 10:11:12' WHEN 3 THEN 'late' ELSE '1 0:30' END"
_ROUTE = "CASE k % 4 WHEN 0 THEN 'San Juan → Ponce -> Vieques' WHEN 1 THEN 'Caguas↔Ponce' WHEN 2 THEN ' -> ' ELSE 'Arecibo' END"


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flight log's times in words or digits and the ends of its routes."""
    t = _texts(spark, sf_dir, tm=_LOG, route=_ROUTE)
    one, last = C.route_ends(F.col("route"))
    return t.select("obs_id", C.log_time(F.col("tm")).alias("time"), one.alias("first_poi"), last.alias("last_poi"))


_PATH = "CASE obs_id % 6 WHEN 0 THEN 'a/b.png' WHEN 1 THEN '../x' WHEN 2 THEN '/etc/x' WHEN 3 THEN 'a\\\\b' WHEN 4 THEN 'a//b' ELSE './a' END"
_NOTE = "CASE k % 4 WHEN 0 THEN 'api_key = 1' WHEN 1 THEN 'tokens' WHEN 2 THEN 'Password' ELSE 'fine' END"


def path_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members whose path or contents a package refuses."""
    t = _texts(spark, sf_dir, path=_PATH.replace("\\\\\\\\", "\\\\"), note=_NOTE)
    nested = F.struct(F.array(F.col("note")).alias("items"))
    return t.select("obs_id", C.safe_path(F.col("path")).alias("safe"), C.holds_secret(nested.alias("n")).alias("secret"))


_WORDS = """'[{"t":"SAN","x":' || CAST(k AS STRING) || ',"y":' || CAST(obs_id % 50 AS STRING) || ',"w":30,"h":10,"c":91.5},{"t":"J","x":1,"y":1,"w":5,"h":5,"c":99},{"t":"JUAN","x":' || CAST(k + 35 AS STRING) || ',"y":20,"w":40,"h":12,"c":' || CAST(obs_id % 100 AS STRING) || '},{"x":3}]'"""


def word_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of two letters and a confidence of 30 at least, in image coordinates (scale 2, offset 10 and 20), and the box
    around them."""
    t = _texts(spark, sf_dir, words=_WORDS)
    found = F.from_json("words", "array<struct<t:string,x:int,y:int,w:int,h:int,c:double>>")
    kept = F.filter(found, lambda w: (F.length(F.trim(w["t"])) >= 2) & (w["c"] >= 30))
    at = lambda c, off: lambda w: F.floor(w[c] / 2).cast("int") + off
    x0, y0 = F.array_min(F.transform(kept, at("x", 10))), F.array_min(F.transform(kept, at("y", 20)))
    x1 = F.array_max(F.transform(kept, lambda w: at("x", 10)(w) + at("w", 0)(w)))
    y1 = F.array_max(F.transform(kept, lambda w: at("y", 20)(w) + at("h", 0)(w)))
    return t.select("obs_id", F.array_join(F.transform(kept, lambda w: w["t"]), " ").alias("text"), x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


QUERIES = {f.__name__: f for f in (whole_image_fields, region_fields, scanned_cards, side_mining, kit_fields, playback_times, flight_dates, epoch_pairs, utc_times, masked_identities, log_entries, path_safety, word_boxes)}

_IMAGE_CONF = _score({"fr24_detected": 0.20, "callsign_or_label IS NOT NULL": 0.20, "aircraft_type IS NOT NULL": 0.15, "registration IS NOT NULL": 0.15, "barometric_altitude_ft IS NOT NULL": 0.10, "ground_speed_mph IS NOT NULL": 0.10, "playback_date IS NOT NULL": 0.10})
_REGION_CONF = _score({"callsign_or_label IS NOT NULL": 0.20, "aircraft_type IS NOT NULL": 0.20, "registration IS NOT NULL": 0.15, "barometric_altitude_ft IS NOT NULL": 0.15, "ground_speed_mph IS NOT NULL": 0.15, "origin_code IS NOT NULL": 0.15})
_IATA_SQL = "(" + ", ".join(f"'{c}'" for c in C.IATA) + ")"
_TIMES = ", ".join(f"try_strptime(both_, '{d} {t}')" for d in ("%b %d, %Y", "%Y-%m-%d") for t in ("%I:%M %p", "%H:%M", "%H:%M:%S"))
ORACLE = {
    "whole_image_fields": f"""{_with(body=_IMAGE, chars=_CHARS)}, s AS (SELECT obs_id, chars, {_SQUEEZE} AS x FROM t),
 f AS (SELECT obs_id, chars, x, regexp_matches(x, '{C.BRAND}') AS fr24_detected, {_REG} AS registration, {_first('x', *C.ALTITUDE)} AS barometric_altitude_ft, {_first('x', *C.GROUND_SPEED)} AS ground_speed_mph,
 {_first('x', *C.DEPARTED)} AS elapsed_departed, {_first('x', *C.ARRIVED)} AS elapsed_arrived, {_first('x', C.PLAYBACK)} AS playback_date, nullif(concat_ws(' ', {_first('x', C.PLAYBACK, group=2)}, {_first('x', C.PLAYBACK, group=3)}), '') AS playback_time,
 {_first('x', C.PLAYBACK, group=4)} AS playback_timezone, {_first('x', *C.CALLSIGN)} AS callsign_or_label, {_first('x', *C.OPERATOR)} AS operator, {_TYPE} AS aircraft_type, {_CODE(1)} AS origin_code, {_CODE(2)} AS destination_code FROM s),
 c AS (SELECT * EXCLUDE (x), {_IMAGE_CONF} AS confidence, CASE WHEN elapsed_arrived IS NOT NULL THEN 'arrived_candidate' WHEN elapsed_departed IS NOT NULL THEN 'departed_candidate' WHEN contains(x, 'Arriving') THEN 'arriving_candidate' END AS flight_status FROM f)
 SELECT * EXCLUDE (chars), CASE WHEN chars < 20 THEN 'low_text_review' WHEN confidence >= 0.70 THEN 'parsed_candidate' ELSE 'manual_review_required' END AS review_status FROM c""",
    "region_fields": f"""{_with(body=_IMAGE, chars=_CHARS, kind=_KIND, ocr=_STATUS)}, s AS (SELECT obs_id, chars, ocr = 'failed' AS failed, lower(coalesce(kind, 'unknown')) AS k, {_SQUEEZE} AS x FROM t),
 r AS (SELECT *, NOT failed AND NOT (chars < 20 AND x = '') AS go, k NOT IN ('callsign', 'altitude', 'speed', 'route') AS rest FROM s),
 f AS (SELECT obs_id, chars, failed, CASE WHEN go AND k = 'callsign' THEN coalesce({_first('x', C.REGION_CALLSIGN)}, nullif(trim(substr(x, 1, 30)), '')) WHEN go AND rest THEN {_first('x', C.REGION_CALLSIGN)} END AS callsign_or_label,
 CASE WHEN go AND rest THEN {_REG} END AS registration, CASE WHEN go AND rest THEN {_TYPE} END AS aircraft_type, CASE WHEN go AND (rest OR k = 'route') THEN {_CODE(1)} END AS origin_code, CASE WHEN go AND (rest OR k = 'route') THEN {_CODE(2)} END AS destination_code,
 CASE WHEN go AND (rest OR k = 'altitude') THEN replace({_first('x', C.REGION_FEET)}, ',', '') END AS barometric_altitude_ft, CASE WHEN go AND (rest OR k = 'speed') THEN {_first('x', C.REGION_MPH)} END AS ground_speed_mph FROM r),
 c AS (SELECT *, {_REGION_CONF} AS confidence FROM f) SELECT * EXCLUDE (chars, failed), CASE WHEN failed THEN 'region_ocr_failed' WHEN chars < 20 THEN 'region_low_text_review' WHEN confidence >= 0.20 THEN 'region_parsed_candidate' ELSE 'region_manual_review_required' END AS review_status FROM c""",
    "scanned_cards": f"""{_with(x=_CARD)}, f AS (SELECT *, {_first('x', *C.REGISTRATION, group=0)} AS registration, TRY_CAST({_first('x', C.SCAN_KNOTS)} AS INT) AS kt, TRY_CAST({_first('x', C.SCAN_MPH)} AS INT) AS mph FROM t)
 SELECT obs_id, registration, CASE WHEN registration IS NULL THEN {_first('x', C.SCAN_CALLSIGN)} END AS callsign, TRY_CAST(replace({_first('x', C.SCAN_FEET)}, ',', '') AS INT) AS altitude_ft, coalesce(kt, CAST(floor(mph * CAST(0.868976 AS DOUBLE)) AS INT)) AS speed_kt, TRY_CAST({_first('x', C.HEADING)} AS INT) AS heading_deg,
 CASE {' '.join(f"WHEN regexp_matches(x, '{p}') THEN '{n}'" for n, p in C.TYPES)} END AS aircraft_type, CASE {' '.join(f"WHEN contains(upper(x), '{p}') THEN '{n}'" for p, n in C.OPERATORS)} END AS operator_text FROM f""",
    "side_mining": f"""{_with(x=_CARD)}, p AS (SELECT *, list_filter(list_transform(regexp_extract_all(x, '{C.PAIR}'), lambda p: regexp_split_to_array(p, '\\s+')), lambda p: p[1] IN {_IATA_SQL} AND p[2] IN {_IATA_SQL} AND p[1] <> p[2])[1] AS r, TRY_CAST({_first('x', C.HEADING)} AS INT) AS hd,
 list_transform(regexp_extract_all(x, '{C.MARKER}'), lambda m: upper(regexp_replace(m, '(?i)\\s*([AP]M)', ' \\1'))) AS h FROM t), q AS (SELECT *, list_filter(h, lambda m, i: list_position(h, m) = i) AS u FROM p)
 SELECT obs_id, r[1] AS origin_iata, r[2] AS destination_iata, CAST({_first('x', C.DEPARTED_AGO)} AS INT) * 60 + CAST({_first('x', C.DEPARTED_AGO, group=2)} AS INT) AS departed_minutes_ago, CAST({_first('x', C.ARRIVING_IN)} AS INT) * 60 + CAST({_first('x', C.ARRIVING_IN, group=2)} AS INT) AS arriving_in_minutes,
 CASE WHEN hd <= 360 THEN hd END AS heading_deg, {_first('x', C.SERIAL)} AS aircraft_serial, CASE WHEN len(u) >= 2 THEN array_to_string(u[1:12], ', ') END AS timeline_hours FROM q""",
    "kit_fields": f"{_with(x=_CARD)}, u AS (" + " UNION ALL ".join(f"SELECT obs_id, '{k}' AS field, {_first('x', p, group=g)} AS value FROM t" for k, (p, g) in C.KIT.items()) + ") SELECT *, 'screen_derived_unverified' AS status FROM u WHERE value IS NOT NULL",
    "playback_times": f"""{_with(d=_DATE, t=_TIME)}, n AS (SELECT obs_id, regexp_replace(trim(d), '^[A-Za-z]{{3}}, ', '') AS d, upper(trim(t)) AS t FROM t), b AS (SELECT *, d || ' ' || t AS both_ FROM n)
 SELECT obs_id, coalesce(CASE WHEN t <> '' THEN coalesce({_TIMES}) END, try_strptime(d, '%b %d, %Y'), try_strptime(d, '%Y-%m-%d')) AS at FROM b""",
    "flight_dates": f"""{_with(name=_FILE, bar=_BAR)}, g AS (SELECT *, regexp_extract(name, '{C.FILE_TIME}', ['y', 'mo', 'd', 'h', 'mi', 's']) AS f, regexp_extract(upper(coalesce(bar, '')), '{C.REPLAY}', ['mo', 'd', 'y']) AS r FROM t),
 c AS (SELECT obs_id, try_strptime(f.y || '-' || f.mo || '-' || f.d || ' ' || f.h || ':' || f.mi || ':' || coalesce(nullif(f.s, ''), '00'), '%Y-%m-%d %H:%M:%S') AS captured, CAST(try_strptime(r.mo || ' ' || r.d || ' ' || r.y, '%b %d %Y') AS DATE) AS told FROM g)
 SELECT obs_id, captured, CASE WHEN told <= CAST(captured AS DATE) THEN told ELSE CAST(captured AS DATE) END AS flight_date, coalesce(told <= CAST(captured AS DATE), false) AS is_replay FROM c""",
    "epoch_pairs": f"""{_with(a=_EPOCH)}, m AS (SELECT obs_id, TRY_CAST(regexp_extract(a, '^(\\d{{4}})-(\\d{{2}})', 1) AS INT) AS y, TRY_CAST(regexp_extract(a, '^(\\d{{4}})-(\\d{{2}})', 2) AS INT) AS m FROM t), i AS (SELECT obs_id, CASE WHEN m BETWEEN 1 AND 12 THEN y * 12 + m END AS month_index FROM m)
 SELECT *, CASE WHEN month_index IS NULL THEN 'unknown' WHEN month_index = 24289 THEN 'same_epoch' WHEN abs(month_index - 24289) = 1 THEN 'adjacent' ELSE 'cross_epoch' END AS pair_class FROM i""",
    "utc_times": f"WITH {OBS} SELECT obs_id, CASE obs_id % 4 WHEN 0 THEN '2024-01-08T14:35:00Z' WHEN 1 THEN '2024-01-08T10:35:07Z' WHEN 3 THEN '2024-01-08T17:30:00Z' END AS utc FROM obs",
    "masked_identities": f"""{_with(tail=_TAIL)}, n AS (SELECT obs_id, trim(coalesce(tail, '')) AS raw, regexp_replace(lower(trim(coalesce(tail, ''))), '[^a-z0-9]+', '', 'g') AS key FROM t),
 s AS (SELECT *, CASE WHEN key = '' OR key IN ('n', 'na', 'unknown', 'blocked', 'masked', 'private', 'none', 'null') OR regexp_full_match(raw, '[*?xX#-]+') THEN 'masked_or_unresolved' WHEN regexp_full_match(key, 'n[0-9a-z]+') THEN 'tail_candidate' ELSE 'unresolved_text' END AS identity_status FROM n)
 SELECT obs_id, identity_status, CASE identity_status WHEN 'tail_candidate' THEN replace(upper(raw), ' ', '') WHEN 'unresolved_text' THEN raw END AS tail_canonical FROM s""",
    "log_entries": f"""{_with(tm=_LOG, route=_ROUTE)}, n AS (SELECT obs_id, lower(trim(tm)) AS s, list_filter(list_transform(regexp_split_to_array(route, '→|->|↔'), lambda p: trim(p)), lambda p: p <> '') AS p FROM t), g AS (SELECT *, regexp_extract(replace(s, ' ', ''), '^(\\d{{1,2}}):(\\d{{2}})(?::(\\d{{2}}))?', ['h', 'm', 's']) AS d FROM n)
 SELECT obs_id, CASE s {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in C.TIME_WORDS.items())} ELSE CASE WHEN d.h <> '' THEN lpad(d.h, 2, '0') || ':' || d.m || ':' || coalesce(nullif(d.s, ''), '00') END END AS time, p[1] AS first_poi, p[-1] AS last_poi FROM g""",
    "path_safety": f"{_with(path='obs_id % 6', note=_NOTE)} SELECT obs_id, path IN (0, 3) AS safe, regexp_matches(note, '{C.SECRET}') AS secret FROM t",
    "word_boxes": f"""{_with(words='k')}, w AS (SELECT obs_id, words // 2 + 10 AS x1, (obs_id % 50) // 2 + 20 AS y1, (words + 35) // 2 + 10 AS x2, obs_id % 100 >= 30 AS two FROM t) SELECT obs_id, CASE WHEN two THEN 'SAN JUAN' ELSE 'SAN' END AS text, CAST(x1 AS INT) AS x,
 CAST(CASE WHEN two THEN least(y1, 30) ELSE y1 END AS INT) AS y, CAST(CASE WHEN two THEN greatest(x1 + 15, x2 + 20) - x1 ELSE 15 END AS INT) AS w, CAST(CASE WHEN two THEN greatest(y1 + 5, 36) - least(y1, 30) ELSE 5 END AS INT) AS h FROM w""",
}
