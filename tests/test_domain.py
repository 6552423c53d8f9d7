"""Operators without SQL against brute force, plug-in sources as streams, and the stage runner."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contrail.functions import cards, tails
from contrail.operators import cuts, gazetteer, graphs
from contrail.plans import places, stages
from contrail.plans.mapping import table
from contrail.sources import plugins, readers, writers


def weighted(a, b):
    """The distance by a table of all prefixes."""
    rows = [[float(j) for j in range(len(b) + 1)]]
    for i, c in enumerate(a, 1):
        rows.append([float(i)])
        for j, d in enumerate(b, 1):
            cost = 0.0 if c == d else 0.5 if c + d in tails.CONFUSED or d + c in tails.CONFUSED else 1.0
            rows[i].append(min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + cost))
    return rows[-1][-1]


def test_weighted_distance_equals_the_table(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("N0O1I5S8B") for _ in range(rng.randint(1, 7))), "".join(rng.choice("N0O1I5S8B") for _ in range(rng.randint(1, 7)))) for _ in range(200)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", tails.weighted_distance(F.col("a"), F.col("b")).alias("d"))
    assert all(r["d"] == weighted(r["a"], r["b"]) for r in rows.collect())


def test_fuzzy_tails_equal_all_pairs(spark, sf):
    reg = sorted({r["tail"] for r in places._registry(spark, sf).collect()})
    want, swapped = {}, False
    for r in places._misread(spark, sf).collect():
        near = sorted((weighted(r["seen"], t), t) for t in reg)
        (d, tail), (after, _) = near[:2]
        if d <= 2 and after - d >= 1 and (d % 1 > 0 or abs(len(r["seen"]) - len(tail)) >= int(d)):
            want[r["c_custkey"]] = near[0]
        swapped |= d <= 2 and after - d >= 1 and r["c_custkey"] not in want
    assert swapped
    got = {r["c_custkey"]: (r["distance"], r["tail"]) for r in places.fuzzy_tails(spark, sf).collect()}
    assert got == want and any(d > 0 for d, _ in got.values())


def test_variants_change_four_places_at_most(spark):
    got = spark.range(1).select(tails.variants(F.lit("N0158")).alias("v")).first()["v"]
    assert len(got) == len(set(got)) == 4 * 7 * 2 * 2 and {"N0158", "NOISB", "NQLSB", "ND|5B", "NOJ58"} <= set(got)
    assert len(spark.range(1).select(tails.variants(F.lit("000000")).alias("v")).first()["v"]) == 4**4


def test_stencil_and_slope(spark):
    cells = spark.createDataFrame([(y, x, 10.0 * x) for y in range(3) for x in range(3)], "y long, x long, z double")
    got = {(r["y"], r["x"]): r["s"] for r in graphs.stencil(cells, "z").select("y", "x", graphs.slope(10.0).alias("s")).collect()}
    assert set(got) == {(y, x) for y in range(3) for x in range(3)} and all(s == pytest.approx(45.0) for s in got.values())


def test_longest_names_first_without_overlap(spark):
    texts = spark.createDataFrame([(1, "rio grande norte bay rio grande"), (2, "grande bay"), (3, None)], "id int, text string").withColumn("w", gazetteer.words(F.col("text")))
    names = spark.createDataFrame([("rio grande", 1), ("grande norte bay", 2), ("grande", 3), ("norte", 4), ("bay", 5)], "key string, p int")
    got = gazetteer.spans(texts, names, "id", "w")
    assert sorted((r["id"], r["start"], r["end"], r["p"]) for r in got.collect()) == [(1, 0, 2, 1), (1, 2, 3, 4), (1, 4, 6, 1), (2, 0, 1, 3)]
    assert {r["id"]: r["names"] for r in gazetteer.scan(got, "id", "key", 1).collect()} == {1: ["rio grande"], 2: ["grande"]}


@pytest.mark.parametrize(
    ("text", "field", "value"),
    [
        ("REG. N407PR BAROMETRIC ALT. 1,500 ft", "registration", "N407PR"), ("REG NO", "registration", None), ("BAROMETRIC ALT. x 1,500 ft", "barometric_altitude_ft", "1,500"),
        ("ABC12 (BQN) Private owner SJU", "callsign_or_label", "ABC12"), ("ABC12 (BQN) Private owner SJU", "operator", "Private owner"), ("from BQN to SJU", "destination_code", "SJU"),
        ("Arrived 00:10 ago Departed 01:00 ago", "flight_status", "arrived_candidate"), ("bell 407", "aircraft_type", "bell 407"), (None, "review_status", "low_text_review"),
    ],
)
def test_whole_image_fields(spark, text, field, value):
    rows = spark.createDataFrame([(text, 0 if text is None else 100)], "t string, n int")
    assert cards.whole_images(rows, "t", "n").first()[field] == value


def test_a_live_provider_streams_its_polls(spark, tmp_path):
    lines = [{"poll": p, "icao24": f"a{p}{i}", "longitude": -66.0, "latitude": 18.0, "last_contact": 100 * p + i} for p in range(3) for i in range(2)]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, lines)))
    spark.dataSource.register(plugins.PositionReports)
    stream = spark.readStream.format("position_reports").options(path=str(tmp_path / "r.jsonl"), polls="3").load()
    q = stream.writeStream.format("memory").queryName("polls").trigger(processingTime="0 seconds").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(60):
            q.processAllAvailable()
            if spark.table("polls").count() >= 6:
                break
    finally:
        q.stop()
    assert {r["icao24"] for r in spark.table("polls").collect()} == {line["icao24"] for line in lines}
    with pytest.raises(ValueError, match="recorded"):
        plugins.provider("elsewhere")


def test_sqlite_without_a_file_has_no_rows(spark, tmp_path):
    spark.dataSource.register(plugins.SqliteTable)
    scan = spark.read.format("sqlite_table").option("path", str(tmp_path / "none.sqlite")).option("table", "t").schema("a int").load()
    assert scan.count() == 0


def test_encodings_are_found_out(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Lat,Lon,time\n18,-66,día\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("﻿lat;lon\n1;2\n".encode())
    assert readers.track_csv(spark, str(tmp_path / "a.csv")).first()["time"] == "día"
    assert readers.csv_sniffed(spark, str(tmp_path / "b.csv")).columns == ["lat", "lon"]


def test_stages_resume_skip_and_start(spark, sf, tmp_path):
    runs = []

    def stage(name, source=None):
        def run(spark, tables):
            runs.append(name)
            return table(spark, sf, "region") if source is None else tables[source].limit(2)

        return run

    all_ = {"one": stage("one"), "two": stage("two", "one"), "three": stage("three", "two")}
    assert set(stages.run_stages(spark, all_, str(tmp_path), skip=["three"])) == {"one", "two"} and runs == ["one", "two"]
    out = stages.run_stages(spark, all_, str(tmp_path))
    assert runs == ["one", "two", "three"] and out["three"].count() == 2
    stages.run_stages(spark, all_, str(tmp_path), resume=False, start="two")
    stages.run_stages(spark, all_, str(tmp_path), resume=False, only="three")
    assert runs == ["one", "two", "three", "two", "three", "three"]
    with pytest.raises(ValueError, match="four"):
        stages.run_stages(spark, all_, str(tmp_path), only="four")


def test_the_gate_names_all_that_is_broken():
    rules = {"weights": lambda c: abs(sum(c["weights"]) - 1) < 1e-9, "owner": lambda c: c["owner"] != "", "limit": lambda c: c["limit"] <= 1}
    stages.gate(rules, {"weights": [0.5, 0.5], "owner": "x", "limit": 1})
    with pytest.raises(stages.GateError, match="weights, owner"):
        stages.gate(rules, {"weights": [0.5], "limit": 1})


def test_queue_states_go_only_where_they_may(spark):
    queue = writers.add_items(spark.createDataFrame([], "item long, seq long, state string"), spark.createDataFrame([(1,), (2,)], "item long"), "item")
    queue = writers.transition(queue, spark.createDataFrame([(1, "approved"), (2, "gone")], "item long, state string"), "item")
    queue = writers.transition(queue, spark.createDataFrame([(1, "rejected")], "item long, state string"), "item")
    assert sorted((r["item"], r["state"]) for r in writers.queue_state(queue, "item", "seq").collect()) == [(1, "approved"), (2, "open")]


@pytest.mark.parametrize("seen, tail, distance, wanted", [("N104", "N109", 1.0, False), ("NIO9", "N109", 1.0, False), ("N1O9", "N109", 0.5, True), ("N1099", "N109", 1.0, True), ("N109", "N109", 0.0, True), ("N19", "N1079", 2.0, True), ("NI44", "N109", 2.5, True)])
def test_a_plain_exchange_is_no_misreading(spark, seen, tail, distance, wanted):
    row = spark.createDataFrame([(seen, tail, distance)], "s string, t string, d double")
    assert row.select(tails.plausible(F.col("s"), F.col("t"), F.col("d")).alias("p")).first()["p"] is wanted


def test_time_words_and_codes_of_a_log(spark):
    rows = spark.createDataFrame([("am",), (" Midday",), ("NOON",), ("pm",), ("evening",), ("7:05",), ("23:05:09",), ("",), (None,)], "t string")
    assert [r["x"] for r in rows.select(cards.log_time(F.col("t")).alias("x")).collect()] == ["09:00:00", "12:00:00", "12:00:00", "15:00:00", None, "07:05:00", "23:05:09", None, None]
    card = spark.createDataFrame([("SEE ALL FAJ SJU x",)], "t string")
    got = card.select(*[c.alias(n) for n, c in cards.mined(F.col("t")).items()]).first()
    assert (got["origin_iata"], got["destination_iata"], len(cards.IATA)) == ("FAJ", "SJU", 46)


def test_distances_of_batches_equal_the_table(spark):
    rng = random.Random(2)
    pairs = [("".join(rng.choice("N0O1I5S8Bé😀") for _ in range(rng.randint(1, 8))), "".join(rng.choice("N0O1I5S8Bé😀") for _ in range(rng.randint(1, 7)))) for _ in range(300)]
    got = spark.createDataFrame(pairs, "seen string, tail string").mapInArrow(tails.with_distances, "seen string, tail string, distance double")
    assert all(r["distance"] == weighted(r["seen"], r["tail"]) for r in got.collect())


def test_tails_that_read_as_a_text_are_its_variants(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("N01T7JBbg") for _ in range(5)) for _ in range(12)]
    rows = spark.createDataFrame([(t,) for t in texts], "seen string").withColumn("v", tails.variants(F.col("seen")))
    others = spark.createDataFrame([(t,) for t in {*texts, *(x for r in rows.collect() for x in r["v"][::7])}], "tail string")
    met = rows.crossJoin(others).select(F.array_contains("v", F.col("tail")).alias("want"), tails.reads_as(F.col("seen"), F.col("tail")).alias("got"), (tails.form(F.upper("seen")) == tails.form(F.col("tail"))).alias("met")).collect()
    assert all(r["want"] == r["got"] and (r["met"] or not r["want"]) for r in met) and sum(r["want"] for r in met) > 12


@pytest.mark.parametrize("share", [0.02, 0.4, 1.0])
def test_fuzzy_tails_of_sparse_and_dense_registries_are_whole_without_broadcasts(spark, sf, monkeypatch, share):
    rng = random.Random(int(share * 100))
    every = [f"N{i:03d}{c}" for i in range(0, 1000, 3) for c in "AB"]
    reg = [t for t in every if rng.random() < share]
    seen = sorted({"".join(rng.choice([c, c, c, c + "X", "", {"0": "O", "1": "I", "5": "S", "8": "B", "6": "G", "B": "8"}.get(c, c), rng.choice("0159OIS")]) for c in rng.choice(every)) for _ in range(150)})
    plans = []
    monkeypatch.setattr(places, "_registry", lambda *_: spark.createDataFrame([(t,) for t in reg], "tail string"))
    monkeypatch.setattr(places, "_misread", lambda *_: spark.createDataFrame(list(enumerate(seen)), "c_custkey long, seen string"))
    monkeypatch.setattr(places, "cut", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cuts.cut(df))[1])
    out = places.fuzzy_tails(spark, sf)
    got = {r["seen"]: (r["distance"], r["tail"]) for r in out.collect()}
    want = {}
    for s in seen:
        (d, tail), *after = sorted((weighted(s, t), t) for t in reg)[:2]
        if d <= 2 and (not after or after[0][0] - d >= 1) and (d % 1 > 0 or abs(len(s) - len(tail)) >= int(d)):
            want[s] = d, tail
    assert got == want and want
    assert not any("BroadcastHashJoin" in p for p in [*plans, out._jdf.queryExecution().executedPlan().toString()])


def test_texts_one_edit_apart_share_one_key_and_others_none(spark):
    texts = ["", "1", "11", "12", "112", "121", "1212", "2121", "3121"]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts if a != b], "a string, b string")
    got = rows.select("a", "b", F.size(F.array_intersect(tails.one_edit_keys(F.col("a")), tails.one_edit_keys(F.col("b"), True))).alias("n"), F.levenshtein("a", "b").alias("d")).collect()
    assert all(r["n"] == int(r["d"] == 1) for r in got) and any(r["n"] for r in got)
    assert set(spark.range(1).select(tails.exchanged(F.lit("N0B")).alias("x")).first()["x"]) == {"NOB", "NQB", "NDB", "N03", "N08"}


def test_any_number_of_doubtful_characters_is_read_as_others(spark):
    pairs = [("NISBOZX", "N15802X", True), ("000000", "QQQQQD", True), ("1111117B", "1111177B", False), ("1111117B", "IIIIITT8", True), ("n0i2s4b", "NQ1Z548", True), ("", "", True), ("NISBOZX", "N15802", False), ("0", "", False), ("A", "4", False)]
    got = spark.createDataFrame(pairs, "a string, b string, want boolean").select("want", tails.reads_as(F.col("a"), F.col("b")).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_variant_tails_know_no_greatest_number_of_misread_places(spark, sf, monkeypatch):
    monkeypatch.setattr(places, "_registry", lambda *_: spark.createDataFrame([("N15815S",), ("N15815T",), ("N00000A",)], "tail string"))
    monkeypatch.setattr(places, "_misread", lambda *_: spark.createDataFrame([(1, "NISBIS5"), (2, "N1SB15S"), (3, "NOQOQOA"), (4, "N4"), (5, "NISBIST")], "c_custkey long, seen string"))
    assert sorted((r["c_custkey"], r["n"], r["tail"]) for r in places.variant_tails(spark, sf).collect()) == [(1, 1, "N15815S"), (2, 1, "N15815S"), (3, 1, "N00000A"), (5, 1, "N15815T")]
