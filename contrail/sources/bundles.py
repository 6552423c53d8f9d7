"""Replay bundles of several sensors: a manifest, its members, and observations, held against their rules and sealed by a digest.

A bundle is a folder with `manifest.json` (protocol, replay_id, sources, members, gaps, and observations or the name of a folder
of JSON lines with them). Nothing is filled in between observations; the timeline is the union of their times.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cards import safe_path
from ..operators.cuts import cut
from ..operators.digests import ordered_digest
from ..operators.joins import small
from .files import hashed

#: The protocol's name, the sensors that it knows, and what their payloads must hold.
PROTOCOL = "skywatcher-multisensor-replay-v1"
PAYLOADS = {
    "aircraft_observation": ("lat", "lon"),
    "provider_rendered_frame": ("member_path", "content_sha256", "product_type"),
    "geomagnetic_timeseries": ("parameter", "value", "unit"),
    "weather_timeseries": ("parameter", "value", "unit"),
}
FRAME = "provider_rendered_frame"


class Bundle(NamedTuple):
    """A bundle's head, and its tables as they are written; members have what was found of them."""

    protocol: str | None
    replay_id: str | None
    sources: DataFrame
    members: DataFrame
    observations: DataFrame
    gaps: DataFrame


def utc(text: Column) -> Column:
    """A time with an explicit offset, in UTC to the microsecond; null for anything else."""
    t = F.trim(text)
    at = F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), t.try_cast("timestamp"))
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _found(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members with the hash and size of their files; those outside the folder are not looked at."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("path").to_pylist(), batch.column("safe").to_pylist(), strict=True)
            found = [hashed(f"{folder}/{path}") if safe else None for path, safe in pairs]
            columns = [pa.array([f and f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("sha256"), *columns], names=["path", "sha256", "found", "size"])

    return look


def read(spark: SparkSession, folder: str) -> Bundle:
    """The bundle in a folder; members are hashed by the tasks that read them."""
    whole = cut(spark.read.text(f"{folder}/manifest.json", wholetext=True).select(F.parse_json("value").alias("m")))
    get = lambda v, name, to="string": F.try_variant_get(v, f"$.{name}", to)
    head = whole.select(get("m", "protocol").alias("protocol"), get("m", "replay_id").alias("replay_id"), get("m", "observations").alias("path"), F.schema_of_variant("m").alias("kind")).first()
    listed = lambda name: whole.select(F.explode(get("m", name, "array<variant>")).alias("x"))
    sources = listed("sources").select(get("x", "source_id").alias("source_id"), get("x", "sensor_type").alias("sensor_type"))
    named = listed("members").select(F.replace(F.coalesce(get("x", "path"), F.lit("")), F.lit("\\"), F.lit("/")).alias("path"), get("x", "sha256").alias("sha256"))
    gaps = listed("gaps").select(*[get("x", c).alias(c) for c in ("source_id", "start_utc", "end_utc")])
    if head["path"] is not None and not head["path"].startswith("["):
        rows = spark.read.text(f"{folder}/{head['path']}").where("trim(value) <> ''").select(F.parse_json("value").alias("x"))
    else:
        rows = listed("observations")
    observations = rows.select(*[get("x", c).alias(c) for c in ("observation_id", "source_id", "sensor_type", "event_time_utc")], get("x", "payload", "variant").alias("payload"))
    safe = named.withColumn("safe", safe_path(F.col("path"))).repartition("path")
    members = safe.mapInArrow(_found(folder), "path string, sha256 string, found string, size long")
    return Bundle(head["protocol"], head["replay_id"], sources, cut(members), cut(observations), gaps)


def _said(rows: DataFrame, rules: dict[str, Column], subject: str) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in rules.items()]))
    return rows.select(F.explode(found).alias("rule"), F.col(subject).cast("string").alias("subject"))


def findings(bundle: Bundle) -> DataFrame:
    """Rows (rule, subject): everything that keeps a bundle from being sealed; none for a sound one."""
    known = F.col("sensor_type").isin(*PAYLOADS)
    twice = lambda key: F.count("*").over(Window.partitionBy(key)) > 1
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    out = _said(bundle.sources.withColumn("_n", twice("source_id")), {"invalid source": blank("source_id") | blank("sensor_type"), "unsupported sensor_type": ~known, "duplicate source_id": F.col("_n")}, "source_id")
    members = bundle.members.withColumn("_n", twice("path"))
    found = F.col("found").isNotNull()
    out = out.unionByName(_said(members, {"unsafe member path": ~safe_path(F.col("path")), "duplicate member path": F.col("_n"), "missing member": safe_path(F.col("path")) & ~found, "content replaced": found & ~F.col("sha256").eqNullSafe(F.col("found"))}, "path"))

    o = bundle.observations
    ids = o.groupBy("observation_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.lit("duplicate observation_id").alias("rule"), F.col("observation_id").alias("subject"))
    sources = bundle.sources.groupBy("source_id").agg(F.first("sensor_type").alias("declared"))
    verified = bundle.members.where("sha256 = found").select(F.col("path").alias("member_path"), F.col("found").alias("_sha")).distinct()
    field = lambda name: F.try_variant_get("payload", f"$.{name}", "string")
    met = o.join(small(cut(sources)), "source_id", "left").withColumn("member_path", F.when(F.col("sensor_type") == FRAME, F.replace(field("member_path"), F.lit("\\"), F.lit("/"))))
    met = met.join(small(verified), "member_path", "left")
    kind = F.regexp_extract(F.schema_of_variant("payload"), "^[A-Z]+", 0)
    lacks = F.lit(False)
    for sensor, names in PAYLOADS.items():
        for n in names:
            lacks = lacks | ((F.col("sensor_type") == sensor) & F.try_variant_get("payload", f"$.{n}", "variant").isNull())
    frame = (F.col("sensor_type") == FRAME) & field("member_path").isNotNull()
    rules = {
        "missing fields": blank("observation_id") | F.col("source_id").isNull() | F.col("sensor_type").isNull() | F.col("event_time_utc").isNull() | F.col("payload").isNull(),
        "unknown source_id": F.col("source_id").isNotNull() & F.col("declared").isNull(),
        "unsupported sensor_type": F.col("sensor_type").isNotNull() & ~known,
        "sensor_type mismatch": F.col("declared") != F.col("sensor_type"),
        "payload is no object": kind != "OBJECT",
        "payload lacks fields": (kind == "OBJECT") & lacks,
        "unsafe member path": frame & ~safe_path(field("member_path")),
        "undeclared member": frame & safe_path(field("member_path")) & F.col("_sha").isNull(),
        "hash differs from member": frame & (F.coalesce(field("content_sha256"), F.lit("")) != F.col("_sha")),
        "wrong product_type": frame & (field("product_type") != FRAME),
        "invalid time": F.col("event_time_utc").isNotNull() & utc(F.col("event_time_utc")).isNull(),
    }
    out = out.unionByName(ids).unionByName(_said(met, rules, "observation_id"))

    start, end = (utc(F.col(c)) for c in ("start_utc", "end_utc"))
    g = bundle.gaps.withColumns({"_s": start, "_e": end}).join(small(cut(sources)), "source_id", "left")
    line = Window.partitionBy("source_id").orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_before", F.max("_e").over(line))
    rules = {"invalid gap": F.col("declared").isNull() | F.col("_s").isNull() | F.col("_e").isNull(), "gap ends before it starts": F.col("_s") >= F.col("_e"), "overlapping gaps": F.col("_s") < F.col("_before")}
    out = out.unionByName(_said(g, rules, "source_id"))
    if bundle.protocol != PROTOCOL:
        out = out.unionByName(out.sparkSession.createDataFrame([("wrong protocol", bundle.protocol)], "rule string, subject string"))
    return out


def receipt(bundle: Bundle) -> dict:
    """What a sound bundle holds, with a digest over all of it; an error that names the first findings of another.

    Members are checked before anything is hashed. The digest covers the head, sources and members by name, observations by
    time and id, and gaps by source and time.
    """
    wrong = [f"{r['rule']}: {r['subject']}" for r in findings(bundle).limit(5).collect()]
    if wrong:
        raise ValueError("; ".join(sorted(wrong)))
    o = bundle.observations.withColumn("event_time_utc", utc(F.col("event_time_utc")))
    text = lambda *names: F.to_json(F.struct(*[F.col(n) for n in sorted(names)]))
    g = bundle.gaps.withColumns({c: utc(F.col(c)) for c in ("start_utc", "end_utc")})
    parts = {
        "sources": ordered_digest(bundle.sources, [F.col("source_id")], text("source_id", "sensor_type")),
        "members": ordered_digest(bundle.members, [F.col("path")], text("path", "sha256", "size")),
        "observations": ordered_digest(o, [F.col("event_time_utc"), F.col("observation_id")], text("event_time_utc", "observation_id", "payload", "sensor_type", "source_id")),
        "gaps": ordered_digest(g, [F.col("start_utc"), F.col("source_id")], text("end_utc", "source_id", "start_utc")),
    }
    counts = o.agg(F.count("*").alias("observation_count"), F.countDistinct("event_time_utc").alias("timestamp_count")).first().asDict()
    head = {"protocol": bundle.protocol, "replay_id": bundle.replay_id, "interpolation": "none", "timeline_policy": "union_observation_timestamps"}
    body = head | {"source_count": bundle.sources.count(), "member_count": bundle.members.count()} | counts
    line = ";".join(f"{k}={v}" for k, v in sorted((body | parts).items()))
    return body | {"content_digest": o.sparkSession.range(1).select(F.sha2(F.lit(line), 256)).first()[0]}
