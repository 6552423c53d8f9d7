"""Sinks: delimited, JSON, GeoJSON and KML files, ledgers, queues and overlays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import last_wins


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def geojson_features(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """One GeoJSON feature a row as text; a point without coordinates has no geometry."""
    others = [c for c in df.columns if c not in (lon, lat)]
    point = F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*others).alias("properties"))).alias("value"))


def one_file(lines: DataFrame, value: str, order: str, head: str, tail: str, path: str, between: str = "") -> None:
    """Text lines in order between a head and a tail as one file, for formats that have a frame: one task writes it, line
    by line, as a single file must be."""
    rows = lines.select(F.col(order).cast("string").alias("_o"), F.lit(1).alias("_p"), F.col(value).alias("_v"))
    last = lines.agg(F.max(F.col(order).cast("string")).alias("_m"))
    rows = rows.join(F.broadcast(last)).withColumn("_v", F.concat("_v", F.when(F.col("_o") == F.col("_m"), "").otherwise(between))).drop("_m")
    frame = lines.sparkSession.createDataFrame([("", 0, head), ("", 2, tail)], "_o string, _p int, _v string")
    rows.union(frame).repartition(1).sortWithinPartitions("_p", "_o").select(F.col("_v").alias("value")).write.mode("overwrite").text(path)


def write_package(streams: dict[str, DataFrame], folder: str, order: dict[str, str]) -> DataFrame:
    """Writes streams as sorted JSON lines with sorted keys below a folder; gives the manifest (name, stream, record_count,
    sha256), a row for each file, and puts it beside them. Empty streams are left out."""
    from .readers import file_manifest

    spark = next(iter(streams.values())).sparkSession
    for name, rows in streams.items():
        if not rows.isEmpty():
            rows.orderBy(order[name]).select(*sorted(rows.columns)).write.mode("overwrite").json(f"{folder}/{name}")
    below = lambda path: F.element_at(F.split(path, F.lit("/" + folder.rstrip("/").rpartition("/")[2] + "/"), 2), 2)
    files = file_manifest(spark, folder, "part-*").select(below(F.col("path")).alias("name"), "sha256")
    lines = spark.read.text(folder, recursiveFileLookup=True, pathGlobFilter="part-*")
    counts = lines.groupBy(below(F.url_decode(F.input_file_name())).alias("name")).agg(F.count("*").alias("record_count"))
    made = files.join(counts, "name").withColumn("stream", F.split_part("name", F.lit("/"), F.lit(1)))
    made.write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.schema("name string, stream string, record_count long, sha256 string").json(f"{folder}/manifest")


def migrate(table: DataFrame, folder: str, steps: dict[int, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Brings a table up to the last of the numbered steps, in order, and notes each in a ledger beside it; steps that the
    ledger has are not taken again. Every version is a table of its own, so what fails leaves the one before it."""
    spark = table.sparkSession
    try:
        done = spark.read.parquet(f"{folder}/ledger").agg(F.max("version")).first()[0]
        now = spark.read.parquet(f"{folder}/v{done}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done, now = -1, table
    for version in sorted(v for v in steps if v > done):
        steps[version](now).write.mode("overwrite").parquet(f"{folder}/v{version}")
        now = spark.read.parquet(f"{folder}/v{version}")
        spark.createDataFrame([(version, now.count())], "version int, rows long").write.mode("append").parquet(f"{folder}/ledger")
    return now


def add_items(queue: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Events of a review queue with those items that it lacks, as open; adding again changes nothing."""
    new = items.dropDuplicates([key]).join(queue.select(key), key, "left_anti")
    return queue.unionByName(new.withColumns({"seq": F.lit(0).cast("long"), "state": F.lit("open")}), allowMissingColumns=True)


#: States that each state may go to.
NEXT = {"open": ("approved", "rejected", "needs_info"), "needs_info": ("approved", "rejected")}


def transition(queue: DataFrame, changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """`queue` with an event for each change (key, state) that its item's last state allows; others are left out."""
    now = queue_state(queue, key, seq).select(key, F.col("state").alias("_s"), F.col(seq).alias("_n"))
    allowed = F.lit(False)
    for one, more in NEXT.items():
        allowed = allowed | ((F.col("_s") == one) & F.col("state").isin(*more))
    made = changes.join(now, key).where(allowed).select(key, (F.col("_n") + 1).alias(seq), "state")
    return queue.unionByName(made, allowMissingColumns=True)


def kml_placemarks(df: DataFrame, name: str, lon: str, lat: str) -> DataFrame:
    """One KML placemark a row as text."""
    safe = F.replace(F.replace(F.replace(F.col(name).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return df.select(F.format_string("<Placemark><name>%s</name><Point><coordinates>%s,%s</coordinates></Point></Placemark>", safe, F.col(lon).cast("string"), F.col(lat).cast("string")).alias("value"))


def pending(parents: DataFrame, children: DataFrame, key: list[str]) -> DataFrame:
    """Parents that have no child row yet: what a resumed run still has to do."""
    return parents.join(children, key, "left_anti")


def queue_state(events: DataFrame, key: str, seq: str) -> DataFrame:
    """The last state of each item of an append-only review queue."""
    return last_wins(events, [key], [F.desc(seq)])


def overlay(base: DataFrame, created: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """Base and created rows with the patches' columns in place of theirs where a patch has a value."""
    both = base.unionByName(created, allowMissingColumns=True)
    p = patches.withColumnsRenamed({c: f"_p_{c}" for c in patches.columns})
    met = both.join(p, F.col(key) == F.col(f"_p_{key}"), "left")
    return met.select(*[F.coalesce(f"_p_{c}", c).alias(c) if c in patches.columns and c != key else F.col(c) for c in both.columns])


def chained(entries: DataFrame, chain: str, seq: str, body: list[str]) -> DataFrame:
    """Entries of append-only ledgers with previous_hash and entry_hash, each over the one before and the entry's body.

    A hash needs the one before it, so each chain is hashed in order by one task; chains are hashed apart.
    """
    import hashlib

    import pandas as pd

    made = entries.withColumn("_body", F.to_json(F.struct(*body)))

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(seq)
        before, prior, own = "", [], []
        for text in frame["_body"]:
            prior.append(before)
            before = hashlib.sha256((before + text).encode()).hexdigest()
            own.append(before)
        return frame.assign(previous_hash=prior, entry_hash=own)

    shape = made.withColumns({"previous_hash": F.lit(""), "entry_hash": F.lit("")}).schema
    return made.groupBy(chain).applyInPandas(link, shape).drop("_body")


def chain_breaks(ledger: DataFrame, chain: str, seq: str, body: list[str]) -> DataFrame:
    """Entries whose hashes do not follow from the entry before them and their own body."""
    before = F.coalesce(F.lag("entry_hash").over(Window.partitionBy(chain).orderBy(seq)), F.lit(""))
    again: Column = F.sha2(F.concat(F.col("previous_hash"), F.to_json(F.struct(*body))), 256)
    return ledger.withColumn("_before", before).where((F.col("previous_hash") != F.col("_before")) | (F.col("entry_hash") != again)).drop("_before")
