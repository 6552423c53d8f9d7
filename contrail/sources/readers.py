"""Scans: CSV, JSON, GeoJSON, KML, GPX, file manifests, packages and registries as DataFrames.

A path that does not exist gives an empty table with the schema asked for. Listings and reads go through Spark's own
readers, so any store that Spark reaches will do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that a track's columns go by.
ALIASES: dict[str, tuple[str, ...]] = {
    "lat": ("lat", "latitude", "y"),
    "lon": ("lon", "lng", "longitude", "x"),
    "time": ("time", "timestamp", "utc", "datetime", "date"),
    "altitude": ("altitude", "alt", "altitude_ft", "elevation"),
    "speed": ("speed", "ground_speed", "speed_mph", "gs"),
    "heading": ("heading", "track", "course", "direction"),
}
#: Roles of files by extension.
ROLES = {"image": ("png", "jpg", "jpeg", "heic", "webp"), "table": ("csv", "tsv", "parquet"), "track": ("kml", "gpx", "geojson"), "record": ("json", "jsonl", "yaml")}


def _or_empty(spark: SparkSession, schema: T.StructType, make) -> DataFrame:
    try:
        return make()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def csv_text(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8", sep: str = ",") -> DataFrame:
    """A CSV file with a header, every column a string, a blank cell null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _or_empty(spark, schema, lambda: spark.read.csv(path, header=True, schema=schema, encoding=encoding, sep=sep, nullValue="", enforceSchema=False))


def csv_typed(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    """A CSV file whose cells are cast one by one, null where a cell is no such value."""
    kinds = T._parse_datatype_string(schema)
    rows = csv_text(spark, path, kinds.fieldNames(), encoding)
    return rows.select(*[F.trim(f.name).try_cast(f.dataType).alias(f.name) for f in kinds])


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file of JSON lines; blank lines are skipped and a bad one is an error."""
    kinds = T._parse_datatype_string(schema)
    return _or_empty(spark, kinds, lambda: spark.read.schema(kinds).json(path, mode="FAILFAST"))


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document that is a list of records, or an object with a list `records`."""
    text = _or_empty(spark, T.StructType([T.StructField("value", T.StringType())]), lambda: spark.read.text(path, wholetext=True))
    items = F.coalesce(F.from_json("value", f"struct<records:array<struct<{schema}>>>")["records"], F.from_json("value", f"array<struct<{schema}>>"))
    return text.select(F.explode(items).alias("r")).where("r is not null").select("r.*")


def geojson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Properties of a feature collection's features with their point's longitude and latitude."""
    shape = f"struct<features:array<struct<properties:struct<{schema}>,geometry:struct<type:string,coordinates:array<double>>>>>"
    text = _or_empty(spark, T.StructType([T.StructField("value", T.StringType())]), lambda: spark.read.text(path, wholetext=True))
    f = text.select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
    return f.select("f.properties.*", F.get("f.geometry.coordinates", 0).alias("lon"), F.get("f.geometry.coordinates", 1).alias("lat"))


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 where all bytes of the files are, else Latin-1, in which any byte is a character."""
    files = spark.read.format("binaryFile").load(path)
    return "UTF-8" if files.where(~F.is_valid_utf8(F.col("content").cast("string"))).isEmpty() else "ISO-8859-1"


def track_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """A track in CSV under any of the known column names; rows without valid coordinates are dropped.

    Without `encoding` it is found out; a mark of byte order before the header is taken off.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, encoding=encoding or encoding_of(spark, path))
    have = {c.strip("\ufeff ").lower(): c for c in raw.columns}
    picked = []
    for name, others in ALIASES.items():
        at = next((have[o] for o in others if o in have), None)
        kind = "string" if name == "time" else "double"
        picked.append((F.trim(F.col(f"`{at}`")).try_cast(kind) if at else F.lit(None).cast(kind)).alias(name))
    return raw.select(*picked).where("lat between -90 and 90 and lon between -180 and 180")


def csv_sniffed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file whose delimiter and encoding are found out from its first line, headers in small letters joined by
    underscores; without a delimiter every line is a value."""
    encoding = encoding_of(spark, path)
    first = spark.read.option("encoding", encoding).text(path).limit(1).collect()
    line = first[0]["value"].strip("\ufeff") if first else ""
    sep = max(",;\t|", key=line.count)
    if not line.count(sep):
        return spark.read.option("encoding", encoding).text(path).where("trim(value) <> ''")
    raw = spark.read.csv(path, header=True, inferSchema=False, sep=sep, encoding=encoding)
    names = [re.sub(r"[^a-z0-9]+", "_", c.strip("\ufeff ").lower()).strip("_") or f"column_{i}" for i, c in enumerate(raw.columns)]
    return raw.toDF(*names)


def cell_kind(cell: Column) -> Column:
    """What a cell's text is: empty, bool, int, float or str, the first that fits."""
    c = F.trim(F.coalesce(cell, F.lit("")))
    number = c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(c == "", "empty").when(F.lower(c).isin("true", "false"), "bool").when(c.rlike(r"^[+-]?\d+$"), "int").when(number, "float").otherwise("str")


def coerced(cell: Column) -> Column:
    """A cell as the kind that its text is: a struct of which one field is set."""
    kind, c = cell_kind(cell), F.trim(cell)
    return F.struct(
        kind.alias("kind"), F.when(kind == "bool", F.lower(c) == "true").alias("as_bool"), F.when(kind == "int", c.try_cast("long")).alias("as_int"),
        F.when(kind == "float", c.try_cast("double")).alias("as_float"), F.when(kind == "str", cell).alias("as_str"),
    )


def csv_ledger(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A ledger in CSV that must have these columns; others are kept, a missing one is an error that names it."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return raw


def yaml_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, section, record, field, values) of registries in YAML: sections of flat records.

    A record begins with a dash; a value is a word, quoted or not, or a list in brackets; comments end lines.
    """
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"(^|\s)#.*$", "")).where("trim(line) <> ''")
    order = Window.partitionBy("file").orderBy("n")
    head = F.regexp_extract("line", r"^([A-Za-z0-9_]+):\s*$", 1)
    lines = lines.withColumns({"section": F.last(F.nullif(head, F.lit("")), True).over(order), "record": F.sum(F.col("line").rlike(r"^\s*- ").cast("int")).over(order)})
    part = lambda g: F.regexp_extract("line", r"^\s*(?:- )?\s*([A-Za-z0-9_]+):\s+(.+?)\s*$", g)
    inner = F.when(part(2).startswith("["), F.split(F.regexp_replace(part(2), r"^\[|\]$", ""), ",")).otherwise(F.array(part(2)))
    values = F.filter(F.transform(inner, lambda v: F.regexp_replace(F.trim(v), r"^[\"']|[\"']$", "")), lambda v: v != "")
    return lines.where(part(1) != "").select("file", "section", "record", part(1).alias("field"), values.alias("values"))


def located(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    """Registry rows that have coordinates."""
    return rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def fill_absent(rows: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """`rows` with each alias as a copy of its column, where no column of that name is there; the originals stay."""
    return rows.withColumns({a: F.col(c) for a, c in aliases.items() if a not in rows.columns})


def xlsx_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, row, cells) of the sheets of XLSX files, every cell as text; each file is read whole by one task.

    Shared and inline texts and numbers are read; a cell that is left out is null.
    """
    import pandas as pd

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile
        from xml.etree import ElementTree

        tag = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                book, rows = zipfile.ZipFile(io.BytesIO(content)), []
                names = [s.get("name") for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(tag + "sheet")]
                texts = []
                if "xl/sharedStrings.xml" in book.namelist():
                    texts = ["".join(t.text or "" for t in si.iter(tag + "t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(tag + "si")]
                for i, name in enumerate(names, 1):
                    for row in ElementTree.fromstring(book.read(f"xl/worksheets/sheet{i}.xml")).iter(tag + "row"):
                        cells: list[str | None] = []
                        for c in row.iter(tag + "c"):
                            at = 0
                            for letter in re.match("[A-Z]*", c.get("r") or "")[0]:
                                at = at * 26 + ord(letter) - 64
                            cells += [None] * (at - 1 - len(cells))
                            value = c.findtext(tag + "v")
                            if c.get("t") == "s" and value is not None:
                                value = texts[int(value)]
                            elif c.get("t") == "inlineStr":
                                value = "".join(t.text or "" for t in c.iter(tag + "t"))
                            cells.append(value)
                        rows.append((file, name, int(row.get("r") or 0), cells))
                yield pd.DataFrame(rows, columns=["file", "sheet", "row", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, "file string, sheet string, row int, cells array<string>")


def sheet_records(rows: DataFrame, fields: dict[str, str], within: int = 10) -> DataFrame:
    """Records of sheets: the header is the first of the `within` first rows that names all fields (field to header, case
    and outer spaces aside); rows after it give the fields, blank ones go."""
    lower = F.transform("cells", lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    named = F.array(*[F.lit(h.lower()) for h in fields.values()])
    heads = rows.where((F.col("row") <= within) & (F.size(F.array_except(named, lower)) == 0))
    heads = heads.groupBy("file", "sheet").agg(F.min(F.struct("row", lower.alias("names"))).alias("h"))
    met = rows.join(heads, ["file", "sheet"]).where(F.col("row") > F.col("h.row"))
    at = {f: F.nullif(F.trim(F.get("cells", F.array_position("h.names", F.lit(h.lower())).cast("int") - 1)), F.lit("")) for f, h in fields.items()}
    found = met.select("sheet", "row", *[c.alias(f) for f, c in at.items()])
    return found.where(F.coalesce(*fields).isNotNull())


def kml_points(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, lon, lat, altitude) of every coordinate in KML files."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    all_ = F.flatten(F.transform(F.regexp_extract_all("value", F.lit(r"(?s)<coordinates>(.*?)</coordinates>"), F.lit(1)), lambda c: F.split(F.trim(c), r"\s+")))
    p = text.select("file", F.posexplode(all_).alias("seq", "p")).withColumn("p", F.split("p", ","))
    at = lambda i: F.get("p", i).try_cast("double")
    return p.select("file", "seq", at(0).alias("lon"), at(1).alias("lat"), at(2).alias("altitude")).where("lon is not null and lat is not null")


def gpx_points(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, lon, lat) of track, route and way points in GPX files."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    tags = F.regexp_extract_all("value", F.lit(r"<(?:trkpt|rtept|wpt)\b[^>]*>"), F.lit(0))
    p = text.select("file", F.posexplode(tags).alias("seq", "t"))
    at = lambda k: F.regexp_extract("t", rf"""\b{k}\s*=\s*["']([^"']+)["']""", 1).try_cast("double")
    return p.select("file", "seq", at("lon").alias("lon"), at("lat").alias("lat")).where("lon is not null and lat is not null")


def file_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, extension, role, size, modified, sha256) of the files below a folder."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    role = F.lit("other")
    for k, exts in ROLES.items():
        role = F.when(ext.isin(*exts), k).otherwise(role)
    return f.select("path", name.alias("name"), ext.alias("extension"), role.alias("role"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def verified_package(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """`manifest` (name, sha256, record_count) with what lies in the folder: found_sha256, found_count, trusted.

    A name is a path below the folder. Rows of a file count as its lines that are not blank; a file that is missing or
    differs is not trusted.
    """
    below = lambda path: F.element_at(F.split(path, F.lit("/" + folder.rstrip("/").rpartition("/")[2] + "/"), 2), 2)
    files = file_manifest(spark, folder).select(below(F.col("path")).alias("name"), F.col("sha256").alias("found_sha256"))
    lines = spark.read.text(folder, recursiveFileLookup=True).where("trim(value) <> ''")
    counts = lines.groupBy(below(F.url_decode(F.input_file_name())).alias("name")).agg(F.count("*").alias("found_count"))
    met = manifest.join(files, "name", "left").join(counts, "name", "left")
    good = F.col("sha256").eqNullSafe(F.col("found_sha256")) & (F.col("record_count") == F.coalesce("found_count", F.lit(0)))
    return met.withColumn("trusted", F.coalesce(good, F.lit(False)))


def entity_views(spark: SparkSession, entities: dict[str, DataFrame], empty: dict[str, str]) -> list[str]:
    """Registers named entities as views, those that have no source yet as empty ones; gives their names."""
    for name, df in entities.items():
        df.createOrReplaceTempView(name)
    for name, schema in empty.items():
        if name not in entities:
            spark.createDataFrame([], schema).createOrReplaceTempView(name)
    return sorted({*entities, *empty})
