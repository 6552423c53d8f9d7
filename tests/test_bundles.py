"""Tree digests and replay bundles."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from contrail.operators import digests
from contrail.sources import bundles


def plain(texts, width):
    level = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + width]).encode()).hexdigest() for i in range(0, len(level), width)]
    return level[0] if level else hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 50])
def test_a_digest_depends_on_rows_and_order_alone(spark, n):
    rows = spark.range(n).select((F.col("id") * 7 % 11).alias("t"), F.col("id").alias("i"), F.concat(F.lit("é"), F.col("id")).alias("c"))
    of = lambda df: digests.ordered_digest(df, [F.col("t"), F.col("i")], F.col("c"), 3)
    want = plain([r["c"] for r in sorted(rows.collect(), key=lambda r: (r["t"], r["i"]))], 3)
    assert of(rows) == of(rows.repartition(5)) == of(rows.coalesce(1)) == want
    if n:
        assert of(rows.withColumn("c", F.when(F.col("i") == n - 1, "x").otherwise(F.col("c")))) != want
        assert of(rows.where(F.col("i") > 0)) != want


def test_rows_equal_in_order_are_ordered_by_themselves(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "z")], "t int, c string")
    of = lambda df: digests.ordered_digest(df, [F.col("t")], F.col("c"))
    assert of(rows) == of(rows.orderBy(F.desc("c")))


FRAME = b"a frame"
SOUND = {
    "protocol": bundles.PROTOCOL,
    "replay_id": "r1",
    "sources": [{"source_id": "a", "sensor_type": "aircraft_observation"}, {"source_id": "f", "sensor_type": "provider_rendered_frame"}],
    "members": [{"path": "in/x 1.png", "sha256": hashlib.sha256(FRAME).hexdigest()}],
    "gaps": [{"source_id": "a", "start_utc": "2024-01-01T05:00:00Z", "end_utc": "2024-01-01T06:00:00Z"}],
    "observations": [
        {"observation_id": "2", "source_id": "f", "sensor_type": "provider_rendered_frame", "event_time_utc": "2024-01-01T02:00:00+02:00", "payload": {"member_path": "in/x 1.png", "content_sha256": hashlib.sha256(FRAME).hexdigest(), "product_type": "provider_rendered_frame"}},
        {"observation_id": "1", "source_id": "a", "sensor_type": "aircraft_observation", "event_time_utc": "2024-01-01T00:00:00Z", "payload": {"lat": 18.0, "lon": -66, "more": [1]}},
    ],
}


def bundle(spark, tmp_path, change):
    manifest = json.loads(json.dumps(SOUND))
    change(manifest)
    folder = tmp_path / "b"
    (folder / "in").mkdir(parents=True, exist_ok=True)
    (folder / "in" / "x 1.png").write_bytes(FRAME)
    (folder / "manifest.json").write_text(json.dumps(manifest))
    return bundles.read(spark, str(folder))


def test_a_sound_bundle_is_sealed(spark, tmp_path):
    got = bundles.receipt(bundle(spark, tmp_path, lambda m: None))
    assert (got["source_count"], got["member_count"], got["observation_count"], got["timestamp_count"], got["replay_id"]) == (2, 1, 2, 1, "r1")
    turned = bundles.receipt(bundle(spark, tmp_path, lambda m: [m[k].reverse() for k in ("sources", "observations")]))
    assert turned["content_digest"] == got["content_digest"]
    for change in (lambda m: m["observations"][1]["payload"].update(lat=18.5), lambda m: m.update(replay_id="r2"), lambda m: m["gaps"].clear()):
        assert bundles.receipt(bundle(spark, tmp_path, change))["content_digest"] != got["content_digest"]


FAULTS = {
    "wrong protocol": lambda m: m.update(protocol="x"),
    "invalid source": lambda m: m["sources"].append({"sensor_type": "weather_timeseries"}),
    "duplicate source_id": lambda m: m["sources"].append(m["sources"][0]),
    "unsupported sensor_type": lambda m: m["sources"].append({"source_id": "z", "sensor_type": "radar"}),
    "duplicate member path": lambda m: m["members"].append(m["members"][0]),
    "unsafe member path": lambda m: m["members"].append({"path": "../up", "sha256": ""}),
    "missing member": lambda m: m["members"].append({"path": "in/none", "sha256": ""}),
    "content replaced": lambda m: m["members"][0].update(sha256="0"),
    "duplicate observation_id": lambda m: m["observations"].append(m["observations"][0]),
    "missing fields": lambda m: m["observations"][1].pop("event_time_utc"),
    "unknown source_id": lambda m: m["observations"][1].update(source_id="q"),
    "sensor_type mismatch": lambda m: m["observations"][1].update(source_id="f"),
    "payload is no object": lambda m: m["observations"][1].update(payload=[1]),
    "payload lacks fields": lambda m: m["observations"][1]["payload"].pop("lat"),
    "undeclared member": lambda m: m["observations"][0]["payload"].update(member_path="in/other"),
    "hash differs from member": lambda m: m["observations"][0]["payload"].update(content_sha256="0"),
    "wrong product_type": lambda m: m["observations"][0]["payload"].update(product_type="x"),
    "invalid time": lambda m: m["observations"][1].update(event_time_utc="2024-01-01T00:00:00"),
    "invalid gap": lambda m: m["gaps"][0].update(source_id="q"),
    "gap ends before it starts": lambda m: m["gaps"][0].update(end_utc="2024-01-01T05:00:00Z"),
    "overlapping gaps": lambda m: m["gaps"].append({"source_id": "a", "start_utc": "2024-01-01T05:30:00Z", "end_utc": "2024-01-01T07:00:00Z"}),
}


@pytest.mark.parametrize("rule", FAULTS)
def test_a_fault_is_found(spark, tmp_path, rule):
    rules = {r["rule"] for r in bundles.findings(bundle(spark, tmp_path, FAULTS[rule])).collect()}
    assert rule in rules and rules <= {rule, "undeclared member"}
    if rule == "content replaced":
        with pytest.raises(ValueError, match="content replaced: in/x 1.png"):
            bundles.receipt(bundle(spark, tmp_path, FAULTS[rule]))
