"""Queries: what the readers give back of what the writers wrote, in every format, and live tables in batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.cuts import shared_folder
from ..sources import plugins, readers, writers
from ..streaming import live
from .mapping import OBS, observations, table


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/exchange-{uuid.uuid4()}"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("obs_id", F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), "kind")


def csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file read back as strings; a missing file has no rows."""
    at = _folder(spark)
    writers.write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("segment")), at)
    rows = readers.csv_text(spark, at, ["c_custkey", "c_name", "segment"])
    return rows.unionByName(readers.csv_text(spark, at + "-none", ["c_custkey", "c_name", "segment"]))


def csv_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells cast one by one; what is no such value is null."""
    at = _folder(spark)
    o = observations(spark, sf_dir)
    writers.write_csv(o.select("obs_id", F.when(F.col("k") % 5 == 0, "n/a").otherwise(F.col("altitude_ft").cast("string")).alias("altitude_ft"), "kind"), at)
    return readers.csv_typed(spark, at, "obs_id long, altitude_ft long, kind string")


_CELL = "CASE obs_id % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN CAST(k AS STRING) WHEN 2 THEN CAST(k AS STRING) || '.5' WHEN 3 THEN '1e3' WHEN 4 THEN ' ' WHEN 5 THEN '+7' ELSE kind END"


def coerced_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cell as what its text is: truth value, whole number, number or text."""
    c = observations(spark, sf_dir).selectExpr("obs_id", f"{_CELL} AS cell")
    return c.select("obs_id", readers.coerced(F.col("cell")).alias("c")).select("obs_id", "c.*")


def sniffed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with semicolons in Latin-1, its header in other words."""
    at = _folder(spark)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("Supplier Key"), F.concat(F.lit("Ñandú é "), "s_name").alias("Full-Name"))
    s.write.csv(at, header=True, sep=";", encoding="ISO-8859-1")
    return readers.csv_sniffed(spark, at)


def track_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks under other column names in another encoding; rows without valid coordinates go."""
    at = _folder(spark)
    o = observations(spark, sf_dir)
    o.select((F.col("lat") + F.when(F.col("k") % 10 == 0, 90).otherwise(0)).alias("Latitude"), F.col("lon").alias("LNG"), F.concat(F.lit("día "), F.col("obs_id").cast("string")).alias("timestamp"), F.col("speed_mph").alias("gs")).write.csv(at, header=True, encoding="ISO-8859-1")
    return readers.track_csv(spark, at).select("time", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "speed")


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _folder(spark)
    writers.write_jsonl(table(spark, sf_dir, "nation"), at)
    return readers.jsonl(spark, at, "n_nationkey long, n_name string, n_regionkey long")


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of JSON documents, one a list and one with a list of records."""
    at = _folder(spark)
    rows = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("id"), F.to_json(F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))).alias("v"))
    writers.one_file(rows.where("id < 2"), "v", "id", "[", "]", at + "/a", ",")
    writers.one_file(rows.where("id >= 2"), "v", "id", '{"records": [', "]}", at + "/b", ",")
    return readers.json_records(spark, at + "/*", "id:long,name:string")


def geojson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature collection in one file."""
    at = _folder(spark)
    p = _points(spark, sf_dir).where("kind = 'purchase'")
    f = p.select("obs_id").join(p, "obs_id")
    lines = writers.geojson_features(f, "lon", "lat")
    keyed = lines.withColumn("o", F.lpad(F.get_json_object("value", "$.properties.obs_id"), 12, "0"))
    writers.one_file(keyed, "value", "o", '{"type": "FeatureCollection", "features": [', "]}", at, ",")
    return readers.geojson(spark, at, "obs_id:long,kind:string")


def kml_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placemarks in one KML file, by their coordinates."""
    at = _folder(spark)
    p = _points(spark, sf_dir).where("kind = 'signup'").withColumn("o", F.lpad(F.col("obs_id").cast("string"), 12, "0"))
    marks = writers.kml_placemarks(p, "o", "lon", "lat").withColumn("o", F.regexp_extract("value", "<name>(.*?)</name>", 1))
    writers.one_file(marks, "value", "o", '<kml xmlns="http://www.opengis.net/kml/2.2"><Document>', "</Document></kml>", at)
    return readers.kml_points(spark, at).select((F.col("seq") + 1).alias("seq"), "lon", "lat")


def gpx_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track, route and way points of a GPX file."""
    at = _folder(spark)
    p = _points(spark, sf_dir)
    tag = F.when(F.col("obs_id") % 3 == 0, "trkpt").when(F.col("obs_id") % 3 == 1, "rtept").otherwise("wpt")
    p.select(F.format_string('<%s lon="%s" lat="%s"></%s>', tag, F.col("lon").cast("string"), F.col("lat").cast("string"), tag)).write.text(at)
    return readers.gpx_points(spark, at).groupBy("lon", "lat").agg(F.count("*").alias("n"))


def file_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a folder by role, with sizes and hashes of their contents."""
    at = _folder(spark)
    table(spark, sf_dir, "region").select(F.concat_ws(",", "r_regionkey", "r_name").alias("value"), F.col("r_regionkey").alias("k")).repartition(1).sortWithinPartitions("k").write.partitionBy("k").text(at)
    m = readers.file_manifest(spark, at, "*.txt")
    return m.select(F.regexp_extract("path", r"k=(\d+)", 1).alias("k"), "extension", "role", "size", "sha256")


def package_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams written as a package and verified against its manifest, one of whose hashes is spoilt."""
    at = _folder(spark)
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    made = writers.write_package({"nations": n.coalesce(1), "regions": r.coalesce(1), "none": r.limit(0)}, at, {"nations": "n_nationkey", "regions": "r_regionkey", "none": "r_regionkey"})
    bent = made.withColumn("sha256", F.when(F.col("stream") == "regions", F.lit("0")).otherwise(F.col("sha256")))
    found = readers.verified_package(spark, at, bent)
    return found.groupBy("stream").agg(F.sum("record_count").alias("records"), F.sum("found_count").alias("found"), F.bool_and("trusted").alias("trusted"))


def sqlite_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of a SQLite file in parts; a missing table has no rows. The file is written from a small dimension."""
    import os
    import sqlite3

    spark.dataSource.register(plugins.SqliteTable)
    base = _folder(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    with sqlite3.connect(f"{base}/n.sqlite") as db:
        db.execute("CREATE TABLE nation (n_nationkey INTEGER, n_name TEXT)")
        # a dimension of 25 rows by the data's own definition
        db.executemany("INSERT INTO nation VALUES (?, ?)", [tuple(r) for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()])
    scan = lambda t: spark.read.format("sqlite_table").option("path", f"{base}/n.sqlite").option("table", t).schema("n_nationkey long, n_name string").load()
    return scan("nation").union(scan("none"))


def yaml_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases of a registry in YAML, one row for each name that a record goes by."""
    at = _folder(spark)
    n = table(spark, sf_dir, "nation").orderBy("n_nationkey")
    lines = n.select(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("o"), F.format_string("  - canonical_name: \"%s\"  # comment\n    aliases: ['%s', %s]\n    region: %s", F.col("n_name"), F.lower("n_name"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.col("n_regionkey").cast("string")).alias("v"))
    writers.one_file(lines, "v", "o", "# registry\nnations:", "", at)
    r = readers.yaml_records(spark, at)
    names = r.where("field = 'canonical_name'").select("file", "record", F.get("values", 0).alias("name"))
    return names.join(r.where("field = 'aliases'").select("file", "record", F.explode("values").alias("alias")), ["file", "record"]).select("name", "alias")


def located_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows with coordinates, under the names that a screen asks for where they are absent."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("airport_id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 4 > 0, F.col("s_acctbal")).alias("lat"), F.col("s_acctbal").alias("lon"), F.lit("kept").alias("icao_code"))
    return readers.fill_absent(readers.located(s, "lat", "lon"), {"airport_name": "name", "icao_code": "name", "latitude": "lat", "longitude": "lon"})


def calibration_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of calibration sets in folders of their own, with the set that a folder is."""
    at = _folder(spark)
    o = observations(spark, sf_dir)
    o.select(F.col("corridor_id").alias("set"), "obs_id", "confidence").write.partitionBy("set").csv(at, header=True)
    rows = spark.read.option("recursiveFileLookup", True).csv(at, header=True).withColumn("set_id", F.regexp_extract(F.input_file_name(), r"set=(\w+)/", 1))
    return rows.groupBy("set_id").agg(F.count("*").alias("labels"), F.round(F.avg(F.col("confidence").cast("double")), 6).alias("mean"))


def contract_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger that has its columns, and what a reader says of one that lacks some."""
    at = _folder(spark)
    writers.write_csv(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), at)
    rows = readers.csv_ledger(spark, at, ["r_regionkey", "r_name"]).select("r_name", F.lit("").alias("lacks"))
    try:
        readers.csv_ledger(spark, at, ["r_regionkey", "r_comment", "r_owner"])
        lacks = ""
    except ValueError as e:
        lacks = str(e).rpartition("columns ")[2]
    return rows.union(spark.createDataFrame([(None, lacks)], rows.schema))


def union_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of different columns in one CSV file whose header is the union of them."""
    at = _folder(spark)
    a = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    b = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("nation"))
    writers.write_csv(a.unionByName(b, allowMissingColumns=True), at)
    return readers.csv_text(spark, at, ["r_regionkey", "r_name", "nation"])


def resumed_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a finished order of every fifth number, which a resumed run would go on with."""
    return writers.pending(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items added twice, states changed where that is allowed, and the last state of each."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").alias("item")
    queue = spark.createDataFrame([], "item long, seq long, state string")
    queue = writers.add_items(writers.add_items(queue, c.where("c_custkey % 2 = 0").select(key), "item"), c.where("c_custkey % 4 < 3").select(key), "item")
    ask = c.where("c_custkey % 3 = 0").select(key, F.when(F.col("c_custkey") % 5 == 0, "needs_info").otherwise("approved").alias("state"))
    queue = writers.transition(queue, ask, "item")
    queue = writers.transition(queue, c.where("c_custkey % 6 = 0").select(key, F.lit("rejected").alias("state")), "item")
    return writers.queue_state(queue, "item", "seq").select("item", "seq", "state")


def upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows, those of new ones put in place of equal keys, and those added only where the key is lacking."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("v"))
    old = c.where("c_custkey % 3 <> 0")
    new = c.where("c_custkey % 2 = 0").withColumn("v", F.lit("new"))
    more = c.withColumn("v", F.lit("missing"))
    return J.insert_missing(J.upsert(old, new, ["c_custkey"]), more, ["c_custkey"])


def replaced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each aircraft and kind, the last by time."""
    return J.last_wins(observations(spark, sf_dir), ["aircraft", "kind"], [F.desc("ts"), F.desc("obs_id")]).select("aircraft", "kind", "obs_id")


def hash_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers chained by hash, one entry then changed: where their checks break."""
    o = observations(spark, sf_dir).where("kind = 'purchase'").select("corridor_id", "obs_id", "value")
    made = writers.chained(o, "corridor_id", "obs_id", ["obs_id", "value"])
    bent = made.withColumn("value", F.when(F.col("obs_id") % 97 == 0, -1.0).otherwise(F.col("value")))
    return writers.chain_breaks(bent, "corridor_id", "obs_id", ["obs_id", "value"]).select("corridor_id", "obs_id")


def session_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and created rows with patches on top."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), "n_name", F.col("n_regionkey").cast("long").alias("r"))
    created = spark.createDataFrame([(100, "NEW")], "id long, n_name string")
    patches = n.where("id % 4 = 0").select("id", F.when(F.col("id") % 8 == 0, "PATCHED").alias("n_name")).union(spark.createDataFrame([(100, "AGAIN")], "id long, n_name string"))
    return writers.overlay(n, created, patches, "id")


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named entities as views, some of them empty, and how many rows each has."""
    names = readers.entity_views(spark, {"airports_view": table(spark, sf_dir, "nation"), "flights_view": table(spark, sf_dir, "orders")}, {"alerts_view": "id long", "flights_view": "id long"})
    counts = [spark.table(n).agg(F.lit(n).alias("entity"), F.count("*").alias("n")) for n in names]
    return counts[0].union(counts[1]).union(counts[2])


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).where("kind = 'click'")
    t = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return o.select(F.lower("aircraft").alias("icao24"), F.when(F.col("k") % 3 > 0, t).alias("time_position"), F.when(F.col("k") % 7 > 0, t + 5).alias("last_contact"))


def polled_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports repeated in a stream of files: late and repeated ones go, times fall back on the last contact."""
    at = _folder(spark)
    rows = _reports(spark, sf_dir)
    rows.union(rows.where("time_position % 2 = 0")).coalesce(1).write.parquet(at + "/in")
    sink = live.ledgered(at + "/out", at + "/ledger")
    stream = live.state_vectors(spark.readStream.schema(rows.schema).parquet(at + "/in"), late="60 days")
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", at + "/c").trigger(availableNow=True).start()
    q.awaitTermination(600)
    out = spark.read.parquet(at + "/out")
    ledger = spark.read.parquet(at + "/ledger").where("status = 'completed'").agg(F.sum("rows").alias("noted"))
    return out.groupBy("icao24").agg(F.count("*").alias("n"), F.min(F.unix_timestamp("event_time")).alias("first_at")).join(F.broadcast(ledger))


def provider_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a named provider within a box, poll by poll."""
    import os

    spark.dataSource.register(plugins.PositionReports)
    base = _folder(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()  # a dimension of 25 rows
    import json

    with open(f"{base}/r.jsonl", "w", encoding="utf-8") as f:
        f.writelines(json.dumps({"poll": r[0] % 3, "icao24": r[1], "longitude": -66.0 + r[0] / 10, "latitude": 18.0, "last_contact": r[0]}) + "\n" for r in n)
    rows = spark.read.format("position_reports").options(provider="Recorded", path=f"{base}/r.jsonl", bbox="-66,17,-65,19", polls="3").load()
    return rows.select("icao24", "last_contact", F.round("longitude", 3).alias("longitude"))


def workbook_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flight log of two sheets in a workbook, its headers below a title, each in other columns. The file is written from
    a small dimension."""
    import io
    import os
    import zipfile

    n = [(r[0], r[1]) for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()]  # a dimension of 25 rows
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'

    def sheet(rows: list[tuple], first: str) -> str:
        cell = lambda i, c, v: f'<c r="{chr(ord(first) + c)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(ord(first) + c)}{i}"><v>{v}</v></c>'
        return f"<worksheet {ns}><sheetData>" + "".join(f'<row r="{i}">' + "".join(cell(i, c, v) for c, v in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1)) + "</sheetData></worksheet>"

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="A"/><sheet name="B"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", sheet([("Log",), ("Tail ", "Number"), *[(b, a) for a, b in n if a % 2]], "A"))
        z.writestr("xl/worksheets/sheet2.xml", sheet([("number", "x", "TAIL"), ("", "", ""), *[(a, "y", b) for a, b in n if not a % 2]], "C"))
    base = _folder(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/log.xlsx", "wb") as f:
        f.write(buffer.getvalue())
    return readers.sheet_records(readers.xlsx_rows(spark, f"{base}/log.xlsx"), {"tail": "Tail", "number": "Number"}).select("sheet", "tail", F.col("number").cast("long").alias("number"))


def migrated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table brought up by three numbered steps in two runs, none taken twice."""
    at = _folder(spark)
    steps = {1: lambda d: d.withColumn("size", F.length("r_name")), 2: lambda d: d.withColumnRenamed("r_name", "name"), 5: lambda d: d.withColumn("size", F.col("size") * 10)}
    start = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    writers.migrate(start, at, {k: v for k, v in steps.items() if k < 5})
    now = writers.migrate(start, at, steps)
    ledger = spark.read.parquet(f"{at}/ledger").agg(F.count("*").alias("steps"), F.sum("rows").alias("noted"))
    return now.join(F.broadcast(ledger))


QUERIES = {
    f.__name__: f
    for f in (
        csv_strings, csv_typed_rows, coerced_cells, sniffed_csv, track_files, json_lines, json_documents, geojson_round_trip, kml_round_trip, gpx_points, file_roles, package_round_trip, sqlite_scan,
        yaml_registry, located_registry, calibration_sets, contract_ledger, union_of_keys, resumed_inserts, review_queue, upserted_rows, replaced_rows, hash_chains, session_overlay, entity_counts,
        polled_reports, provider_reports, workbook_log, migrated_table,
    )
}

_POINTS = f"WITH {OBS}, p AS (SELECT obs_id, round(lat, 5) AS lat, round(lon, 5) AS lon, kind FROM obs)"
ORACLE = {
    "csv_strings": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS segment FROM customer",
    "csv_typed_rows": f"WITH {OBS} SELECT obs_id, CASE WHEN k % 5 <> 0 THEN altitude_ft END AS altitude_ft, kind FROM obs",
    "coerced_cells": f"WITH {OBS} SELECT obs_id, CASE obs_id % 7 WHEN 0 THEN 'bool' WHEN 1 THEN 'int' WHEN 2 THEN 'float' WHEN 3 THEN 'float' WHEN 4 THEN 'empty' WHEN 5 THEN 'int' ELSE 'str' END AS kind, CASE WHEN obs_id % 7 = 0 THEN true END AS as_bool, CASE obs_id % 7 WHEN 1 THEN k WHEN 5 THEN 7 END AS as_int, CASE obs_id % 7 WHEN 2 THEN k + CAST(0.5 AS DOUBLE) WHEN 3 THEN 1000 END AS as_float, CASE WHEN obs_id % 7 = 6 THEN kind END AS as_str FROM obs",
    "sniffed_csv": "SELECT CAST(s_suppkey AS VARCHAR) AS supplier_key, 'Ñandú é ' || s_name AS full_name FROM supplier",
    "track_files": f"WITH {OBS} SELECT 'día ' || obs_id AS time, round(lat, 6) AS lat, round(lon, 6) AS lon, speed_mph AS speed FROM obs WHERE k % 10 <> 0",
    "json_lines": "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation",
    "json_documents": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region",
    "geojson_round_trip": f"{_POINTS} SELECT * FROM p WHERE kind = 'purchase'",
    "kml_round_trip": f"{_POINTS} SELECT CAST(row_number() OVER (ORDER BY obs_id) AS INT) AS seq, lon, lat FROM p WHERE kind = 'signup'",
    "gpx_points": f"{_POINTS} SELECT lon, lat, count(*) AS n FROM p GROUP BY 1, 2",
    "file_roles": "SELECT CAST(r_regionkey AS VARCHAR) AS k, 'txt' AS extension, 'other' AS role, strlen(r_regionkey || ',' || r_name) + 1 AS size, sha256(r_regionkey || ',' || r_name || chr(10)) AS sha256 FROM region",
    "package_round_trip": "SELECT 'nations' AS stream, count(*) AS records, count(*) AS found, true AS trusted FROM nation UNION ALL SELECT 'regions', count(*), count(*), false FROM region",
    "sqlite_scan": "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation",
    "yaml_registry": "SELECT n_name AS name, unnest([lower(n_name), 'n' || n_nationkey]) AS alias FROM nation",
    "located_registry": "SELECT s_suppkey AS airport_id, s_name AS name, s_acctbal AS lat, s_acctbal AS lon, 'kept' AS icao_code, s_name AS airport_name, s_acctbal AS latitude, s_acctbal AS longitude FROM supplier WHERE s_suppkey % 4 > 0",
    "calibration_sets": f"WITH {OBS} SELECT corridor_id AS set_id, count(*) AS labels, round(avg(confidence), 6) AS mean FROM obs GROUP BY 1",
    "contract_ledger": "SELECT r_name, '' AS lacks FROM region UNION ALL SELECT NULL, 'r_comment, r_owner'",
    "union_of_keys": "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name, NULL AS nation FROM region UNION ALL SELECT CAST(n_regionkey AS VARCHAR), NULL, n_name FROM nation",
    "resumed_inserts": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000)",
    "review_queue": "WITH i AS (SELECT c_custkey AS item FROM customer WHERE c_custkey % 4 < 3) SELECT item, CASE WHEN item % 3 <> 0 THEN 0 WHEN item % 6 = 0 AND item % 5 = 0 THEN 2 ELSE 1 END AS seq, CASE WHEN item % 3 <> 0 THEN 'open' WHEN item % 5 <> 0 THEN 'approved' WHEN item % 6 = 0 THEN 'rejected' ELSE 'needs_info' END AS state FROM i",
    "upserted_rows": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE 'missing' END AS v FROM customer",
    "replaced_rows": f"WITH {OBS} SELECT aircraft, kind, obs_id FROM obs QUALIFY row_number() OVER (PARTITION BY aircraft, kind ORDER BY ts DESC, obs_id DESC) = 1",
    "hash_chains": f"WITH {OBS} SELECT corridor_id, obs_id FROM obs WHERE kind = 'purchase' AND obs_id % 97 = 0",
    "session_overlay": "SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey % 8 = 0 THEN 'PATCHED' ELSE n_name END AS n_name, CAST(n_regionkey AS BIGINT) AS r FROM nation UNION ALL SELECT 100, 'AGAIN', NULL",
    "entity_counts": "SELECT 'airports_view' AS entity, count(*) AS n FROM nation UNION ALL SELECT 'flights_view', count(*) FROM orders UNION ALL SELECT 'alerts_view', 0",
    "polled_reports": f"WITH {OBS}, r AS (SELECT DISTINCT lower(aircraft) AS icao24, coalesce(CASE WHEN k % 3 > 0 THEN epoch_us(ts) // 1000000 END, CASE WHEN k % 7 > 0 THEN epoch_us(ts) // 1000000 + 5 END) AS t FROM obs WHERE kind = 'click') SELECT icao24, count(*) AS n, min(t) AS first_at, (SELECT count(*) FROM r WHERE t IS NOT NULL) AS noted FROM r WHERE t IS NOT NULL GROUP BY 1",
    "workbook_log": "SELECT CASE WHEN n_nationkey % 2 = 1 THEN 'A' ELSE 'B' END AS sheet, n_name AS tail, CAST(n_nationkey AS BIGINT) AS number FROM nation",
    "migrated_table": "SELECT r_regionkey, r_name AS name, CAST(length(r_name) * 10 AS INT) AS size, 3 AS steps, 3 * (SELECT count(*) FROM region) AS noted FROM region",
    "provider_reports": "SELECT n_name AS icao24, CAST(n_nationkey AS BIGINT) AS last_contact, round(-66.0 + n_nationkey / CAST(10 AS DOUBLE), 3) AS longitude FROM nation WHERE n_nationkey <= 10",
}
