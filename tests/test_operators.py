"""Operators on literal rows, with the edges at each threshold."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from contrail.functions import evidence, geo, text
from contrail.operators import aggregates, graphs, joins, windows
from contrail.sources import readers, writers


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_band_join_includes_the_edge(spark):
    a = spark.createDataFrame([("x", at(0)), ("x", at(61))], "k string, a timestamp_ntz")
    b = spark.createDataFrame([("x", at(60)), ("y", at(0))], "k string, b timestamp_ntz")
    assert values(joins.band_join(a, b, ["k"], "a", "b", 3600), "a", "b") == [(at(0), at(60)), (at(61), at(60))]


def test_radius_join_equals_brute_force(spark):
    pts = spark.createDataFrame([(i, -80 + i * 8.05, -179.9 + i * 17.3) for i in range(20)], "i int, la double, lo double")
    q = spark.createDataFrame([(i, -80 + i * 8.0, -179.9 + i * 17.2) for i in range(20)], "j int, lb double, lp double")
    got = joins.radius_join(pts, q, 150.0, ("la", "lo"), ("lb", "lp"))
    d = geo.haversine(F.col("la"), F.col("lo"), F.col("lb"), F.col("lp"))
    assert values(got, "i", "j") == values(pts.crossJoin(q).where(d <= 150.0), "i", "j")


def test_nearest_breaks_ties_by_order(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "i int, la double, lo double")
    q = spark.createDataFrame([(2, 0.0, 1.0), (1, 0.0, -1.0)], "j int, lb double, lp double")
    assert values(joins.nearest(p, q, "i", ("la", "lo"), ("lb", "lp"), [F.col("j")]), "i", "j") == [(1, 1)]


def test_hamming_pairs_at_the_limit(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0b1111), (3, 0b11111), (4, -1)], "i long, h long")
    assert values(joins.hamming_pairs(rows, "i", "h", 4), "a", "b", "distance") == [(1, 2, 4), (2, 3, 1)]


def test_hamming_pairs_with_a_flipped_bit_in_each_piece(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0x1111111111111111)], "i long, h long")
    assert values(joins.hamming_pairs(rows, "i", "h", 16), "a", "b", "distance") == [(1, 2, 16)]


def test_card_fields_reads_every_observation(spark, tmp_path):
    from contrail.plans import review

    rows = [(i, 7, at(i % 60), "view", 1.0, '{"k": 3}') for i in (5, 99_999, 100_000, 2_000_001)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    assert values(review.card_fields(spark, str(tmp_path)), "obs_id") == [(5,), (99_999,), (100_000,), (2_000_001,)]


def test_one_to_one_takes_the_cheapest_first(spark):
    rows = spark.createDataFrame([("c", "a", "x", 2), ("c", "a", "y", 1), ("c", "b", "y", 1), ("c", "b", "x", 9)], "g string, l string, r string, d int")
    assert values(graphs.one_to_one(rows, "l", "r", ["d"]), "l", "r") == [("a", "y"), ("b", "x")]


def test_one_to_one_equals_going_through_all_pairs(spark):
    rng = random.Random(2)
    pairs = sorted({(rng.randrange(30), rng.randrange(30)): rng.randrange(6) for _ in range(200)}.items(), key=lambda p: (p[1], *p[0]))
    lefts, rights, want = set(), set(), []
    for (a, b), _ in pairs:
        if a not in lefts and b not in rights:
            want.append((a, b))
            lefts.add(a)
            rights.add(b)
    rows = spark.createDataFrame([(a, b, d) for (a, b), d in pairs], "l int, r int, d int")
    assert values(graphs.one_to_one(rows, "l", "r", ["d"]), "l", "r") == sorted(want)


def test_leader_groups_equal_going_in_order(spark):
    rng = random.Random(3)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)}
    want = {}
    for x in range(40):
        led = [a for a, b in sorted(pairs) if b == x and want[a] == a]
        want[x] = min(led) if led else x
    got = graphs.leader_groups(spark.range(40).withColumnRenamed("id", "node"), spark.createDataFrame(list(pairs), "a long, b long"))
    assert {r["node"]: r["leader"] for r in got.collect()} == want


def test_nearest_keeps_repeated_points_among_many_places(spark):
    p = spark.createDataFrame([(1, 18.0, -66.0), (1, 18.0, -66.0), (2, -50.0, 179.95), (3, None, 1.0)], "i int, la double, lo double")
    q = spark.range(60_000).select("id", (F.col("id") % 300 / 100 + 17).alias("lb"), (F.col("id") / 60_000 - 67).alias("lp"))
    q = q.union(spark.createDataFrame([(-1, -50.0, -179.95)], "id long, lb double, lp double"))
    got = joins.nearest(p, q, "i", ("la", "lo"), ("lb", "lp"), [F.col("id")])
    d = geo.haversine(F.col("la"), F.col("lo"), F.col("lb"), F.col("lp"))
    best = p.where("i = 1").limit(1).crossJoin(q).orderBy(d, "id").first()["id"]
    assert values(got, "i", "id") == [(1, best), (1, best), (2, -1)]


def test_boxes_hold_their_edges(spark):
    p = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.0001), (3, -0.05, -0.05)], "i int, la double, lo double")
    b = spark.createDataFrame([(7, 0.5, 1.5, 1.0, 2.0), (8, -1.0, -1.0, 1.0, 3.0)], "j int, s double, w double, n double, e double")
    assert values(joins.box_join(p, b, ("la", "lo"), ("s", "w", "n", "e"), 0.4), "i", "j") == [(1, 7), (1, 8), (2, 8), (3, 8)]


def test_upsert_and_insert_missing(spark):
    old, new = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert values(joins.upsert(old, new, ["k"]), "k", "v") == [(1, "b"), (2, "c")]
    assert values(joins.insert_missing(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "c")]


def test_mode_keeps_the_first_seen(spark):
    rows = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("g", "a", 3), ("g", "b", 4), ("g", None, 0)], "g string, v string, s int")
    assert values(aggregates.mode_first(rows, ["g"], "v", "s"), "g", "v", "n") == [("g", "b", 2)]


def test_anomalies_suppress_below_the_band(spark):
    now = spark.createDataFrame([("a", "x", 10.0, 0.0), ("a", "y", 20.0, 1.0), ("b", "x", 1.0, 0.0)], "corridor_id string, domain string, current_count double, confidence double")
    past = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 10.0)], "corridor_id string, domain string, historical_count double")
    assert values(aggregates.anomalies(now, past), "domain", "anomaly_score", "review_band") == [("y", 1.0, "high_review")]


def test_sessions_keep_a_gap_of_exactly_an_hour(spark):
    rows = spark.createDataFrame([("a", at(0), 1), ("a", at(60), 2), ("a", at(121), 3)], "k string, t timestamp_ntz, i int")
    assert values(windows.sessions(rows, ["k"], "t", "i", 60), "i", "session") == [(1, 1), (2, 1), (3, 2)]


def test_pair_checks_count_interior_speeds_twice(spark):
    rows = spark.createDataFrame([("a", at(0), 1, 0, 10.0), ("a", at(1), 2, 1501, 200.0), ("a", at(2), 3, 1501, 10.0), ("b", at(0), 4, 0, 999.0)], "k string, t timestamp_ntz, i int, alt int, v double")
    got = windows.pair_checks(rows, "k", "t", "i", "alt", "v")
    assert values(got, "k", "observations", "backward", "climb", "speed") == [("a", 3, 0, 1, 2), ("b", 1, 0, 0, 0)]


def test_batch_plan_numbers_all_rows(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = windows.batch_plan(rows, [F.col("v")], 64)
    assert values(got.select((F.col("batch_index") * 64 + F.col("position") - F.col("v")).alias("d")).distinct(), "d") == [(0,)]


def test_segment_distance_and_cells(spark):
    one = spark.range(1)
    d = geo.segment_nm(*[F.lit(x) for x in (0.0, 1.0, -1.0, 0.0, 1.0, 0.0)])
    row = one.select(d.alias("d"), geo.cell(F.lit(-66.07), 0.05).alias("c"), geo.near_cell(F.lit(2.5), 1.0).alias("r")).first()
    assert row["d"] == pytest.approx(60.04, abs=0.01) and (row["c"], row["r"]) == (-1321, 2)


def test_evidence_clamps_after_the_sum(spark):
    family = evidence.FAMILIES["patchwork"]
    signals = F.create_map(*[F.lit(x) for k in family.signals for x in (k, 2.0)], F.lit("UNKNOWN"), F.lit(5.0))
    row = spark.range(1).select(evidence.signal_score(signals, family).alias("s"), evidence.discounted(F.lit(1.0), F.lit(2.0)).alias("d")).first()
    assert (row["s"], row["d"]) == (1.0, 0.5)


@pytest.mark.parametrize(("tail", "good"), [("N1", True), ("N12345", True), ("N123AB", True), ("N12I", False), ("N0", False), ("X1", False), (None, False)])
def test_n_numbers(spark, tail, good):
    assert spark.range(1).select(text.n_number(F.lit(tail).cast("string")).alias("x")).first()["x"] is good


def test_banned_tokens_ignore_case_and_spaces(spark):
    rows = spark.createDataFrame([(" Confirmed ",), ("unconfirmed",), (None,)], "s string")
    assert rows.where(text.has_banned(F.col("s"))).count() == 1


def test_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Latitude,LNG,timestamp,alt\n18.1,-66,2024-01-01,x\n91,0,,\n,,,\n")
    assert values(readers.track_csv(spark, str(tmp_path / "t.csv")), "lat", "lon") == [(18.1, -66.0)]
    assert readers.csv_text(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
    (tmp_path / "k.kml").write_text("<kml><coordinates>\n-66,18,5 -67,19\n</coordinates><coordinates>bad</coordinates></kml>")
    assert values(readers.kml_points(spark, str(tmp_path / "k.kml")), "lon", "lat") == [(-67.0, 19.0), (-66.0, 18.0)]
    (tmp_path / "g.gpx").write_text('<gpx><trkpt lat="1" lon="2"/><wpt lon="4" lat="3"></wpt></gpx>')
    assert values(readers.gpx_points(spark, str(tmp_path / "g.gpx")), "lon", "lat") == [(2.0, 1.0), (4.0, 3.0)]
    (tmp_path / "r.json").write_text('{"records": [{"a": 1}, {"a": 2}]}')
    assert values(readers.json_records(spark, str(tmp_path / "r.json"), "a:int"), "a") == [(1,), (2,)]
    (tmp_path / "f.json").write_text('{"features": [{"properties": {"n": "x"}, "geometry": {"type": "Point", "coordinates": [1.5, 2.5]}}]}')
    assert values(readers.geojson(spark, str(tmp_path / "f.json"), "n:string"), "n", "lon", "lat") == [("x", 1.5, 2.5)]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert readers.jsonl(spark, str(tmp_path / "l.jsonl"), "a int").count() == 2


def test_packages_fail_closed(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("{}\n{}\n")
    import hashlib

    good = hashlib.sha256(b"{}\n{}\n").hexdigest()
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.jsonl").write_text("{}\n")
    m = spark.createDataFrame([("a.jsonl", good, 2), ("b.jsonl", good, 2), ("sub/a.jsonl", good, 2)], "name string, sha256 string, record_count int")
    assert values(readers.verified_package(spark, str(tmp_path), m), "name", "trusted") == [("a.jsonl", True), ("b.jsonl", False), ("sub/a.jsonl", False)]


def test_ledger_chain_breaks_where_a_body_changes(spark):
    rows = spark.createDataFrame([("c", i, f"v{i}") for i in range(5)], "c string, i int, v string")
    made = writers.chained(rows, "c", "i", ["i", "v"])
    assert writers.chain_breaks(made, "c", "i", ["i", "v"]).count() == 0
    bent = made.withColumn("v", F.when(F.col("i") == 2, "bent").otherwise(F.col("v")))
    assert values(writers.chain_breaks(bent, "c", "i", ["i", "v"]), "i") == [(2,)]


def test_overlay_patches_win(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    created = spark.createDataFrame([(3, "c")], "k int, v string")
    patches = spark.createDataFrame([(1, "z"), (2, None)], "k int, v string")
    assert values(writers.overlay(base, created, patches, "k").na.fill("-"), "k", "v", "w") == [(1, "z", "x"), (2, "b", "y"), (3, "c", "-")]


def test_a_running_maximum_crosses_ranges(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", "a", None]), i, rng.choice([None, 1.0, 5.0, float(i % 40)])) for i in range(300)]
    want, most = [], {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        most[g] = max((x for x in (most.get(g), v) if x is not None), default=None)
        want.append((i, most[g]))
    df = spark.createDataFrame(rows, "g string, i int, v double").repartition(6)
    assert sorted((r["i"], r["m"]) for r in windows.running_max(df, "g", "v", [F.col("i")], "m").collect()) == want
