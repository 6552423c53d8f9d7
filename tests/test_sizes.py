"""What must not grow: copies of rows, pairs that are rows, and texts carried along."""

import math
import random

import pytest
from pyspark.sql import functions as F

from contrail.functions import cards
from contrail.operators import gazetteer, joins
from contrail.plans import grids, matching, places


def test_rows_are_copied_to_what_the_band_and_radius_reach(spark):
    rows = spark.range(500).select((F.col("id") * 613.7).cast("timestamp").alias("t"), (F.col("id") % 60 * 1.0).alias("la"), (F.col("id") * 7.3 % 360 - 180).alias("lo"))
    _, two = joins._time_buckets(rows, rows, "t", "t", 600)
    assert 500 < two.count() <= 1000
    plan = joins.band_join(rows, rows.toDF("t2", "la2", "lo2"), [], "t", "t2", 600, how="left")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan


def test_few_places_are_compared_without_rows_of_pairs(spark, sf):
    for query in (matching.nearest_airport, places.nearest_layered_place, grids.zone_containment):
        assert "lat" in query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    points = spark.createDataFrame([(i, 18.0, -67.0) for i in range(50)], "i int, la double, lo double")
    near = joins.nearest(points, spark.createDataFrame([(1, 18.1, -67.0), (2, 18.1, -67.0), (3, None, None)], "p int, a double, b double"), "i", ("la", "lo"), ("a", "b"), [-F.col("p")])
    assert near.count() == 50 and {r["p"] for r in near.collect()} == {2}
    assert "SortAggregate" not in near._jdf.queryExecution().executedPlan().toString()


def test_no_row_of_a_run_of_words_holds_the_text(spark):
    texts = spark.createDataFrame([(1, ["rio", "grande", "bay"] * 3)], "id int, w array<string>")
    found = gazetteer.spans(texts, spark.createDataFrame([("rio grande", 1)], "key string, p int"), "id", "w")
    assert found.count() == 3 and "arrays_zip" in found._jdf.queryExecution().optimizedPlan().toString()


def test_regions_of_an_order_pair_within_its_row(spark, sf):
    plan = matching.poi_pair_flights(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("l_suppkey#") > 0 and "collect_set" in plan


def test_pairs_in_time_are_grouped_where_they_meet(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = places.pairing_ledger(spark, sf)._jdf.queryExecution().executedPlan().toString().split("Union")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x and "_bucket" in x)
    assert not any("Exchange" in x for x in lines[:join])


def test_texts_without_what_a_pattern_needs_are_not_searched_and_none_is_missed(spark, sf):
    samples = [
        "FLIGHT  radar REG no", "\u0130 glightRADAR reg. n12ab (AB1) x", "Lockheed Martin C130J30 super Herc. x", "lockheed c-130t hercules", "MCDONNELL DOUGLAS AV-8B+ HARRIER II", "boeing c17a globemaster iii BELL 407",
        "grumman c2a greyhound", "sikorsky mh60t jayhawk", "ROBINSON R44 raven ii", "icon a5", "Barometric Alt about 1,200 FT GROUND speed: 90 MPH", "...PARTED 1:00 ago ARRIVED2:00 ago Departed 3 ago", "1,100 ft ground speed", "\u212aEJA netjets N1A (x)", "", " ",
    ]
    rows = spark.createDataFrame([(x,) for x in samples], "t string").withColumn("low", F.lower("t"))
    for pattern in cards.NEEDS:
        both = rows.select(cards.first(F.col("t"), pattern, group=0).alias("a"), cards.first(F.col("t"), pattern, group=0, low=F.col("low")).alias("b")).collect()
        assert [r["a"] for r in both] == [r["b"] for r in both]
    plan = spark.createDataFrame([("x", 1)], "t string, n int")
    plan = cards.whole_images(plan, "t", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(_t") <= 36 and plan.count("(?:Mon|") <= 5


def test_a_picture_meets_a_track_once_so_that_no_pair_is_grouped(spark, sf):
    lines = places.pairing_ledger(spark, sf)._jdf.queryExecution().executedPlan().toString().split("Union")[1].splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x and "_bucket" in x)
    assert not any(w in x for x in lines[:join] for w in ("Aggregate", "Sort", "Exchange"))


def test_spans_of_the_nearest_rows_hold_every_time_once(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.randrange(-300, 300)) for _ in range(90)] + [("a", 7)] * 3 + [(None, 5)]
    times = [(i, rng.randrange(-340, 340)) for i in range(150)]
    spans = joins.nearest_spans(spark.createDataFrame(rows, "k string, t long"), "k", "t", 20)
    got = joins.span_join(spark.createDataFrame(times, "i long, v long"), spans, "v", "low", "high", 41, "left").collect()
    want = {(i, k): min(abs(v - t) for x, t in rows if x == k) for i, v in times for k in ("a", "b", "c", None)}
    want = {x: d for x, d in want.items() if d <= 20}
    assert sorted((r["i"], str(r["k"]), abs(r["v"] - r["t"])) for r in got if r["t"] is not None) == sorted((i, str(k), d) for (i, k), d in want.items())
    assert {r["i"] for r in got if r["t"] is None} == {i for i, _ in times} - {i for i, _ in want} != set()


@pytest.mark.parametrize("looked_at", [5, 200_000])
def test_pairs_in_time_and_place_are_picked_within_groups(spark, sf, monkeypatch, looked_at):
    assert "Join" not in matching.cross_domain_overlaps(spark, sf)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "LOOKED_AT", looked_at)
    rng = random.Random(looked_at)
    rows = [(i, rng.randrange(0, 90_000), rng.choice([18.0, 18.1, -70.0]) + rng.random() / 2, rng.choice([-180.2, 179.8, -66.0]) + rng.random() / 2, rng.choice("ab")) for i in range(240)]
    rows = [(i, t, la, lo if lo >= -180 else lo + 360, k) for i, t, la, lo, k in rows]
    odd = [(900, None, 18.0, -66.0, "a"), (901, 5, None, -66.0, "a"), (902, 5, 18.0, None, "a"), (903, 40, 18.1, -66.0, None), (904, 40, 18.1, -66.0, None)]
    frame = spark.createDataFrame([*rows, *odd], "i long, s long, la double, lo double, k string").withColumn("t", F.timestamp_seconds("s")).drop("s")
    one, two = frame.where("i % 2 = 0"), frame.where("i % 2 = 1").toDF(*[f"{c}2" for c in frame.columns])
    got = joins.band_radius_join(one, two, "t", "t2", 1800, 40.0, ("la", "lo"), ("la2", "lo2"), ("k", "k2")).collect()

    def km(a, b):
        x = math.sin(math.radians(b[2] - a[2]) / 2) ** 2 + math.cos(math.radians(a[2])) * math.cos(math.radians(b[2])) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(x))

    rows += odd[3:]
    want = {(a[0], b[0]): (abs(a[1] - b[1]) * 1_000_000, km(a, b), a[4] == b[4] is not None) for a in rows for b in rows if a[0] % 2 == 0 and b[0] % 2 == 1 and abs(a[1] - b[1]) <= 1800 and km(a, b) <= 40}
    assert {(r["i"], r["i2"]): (r["apart_us"], pytest.approx(r["distance_km"], abs=1e-9), r["alike"]) for r in got} == want and len(got) == len(want) > 20
