"""Zoom ladders against plain loops."""

import math
import random
from collections import defaultdict
from statistics import median

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.operators import ladders
from contrail.plans import more


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.booleans()), max_size=40))
def test_a_running_median_equals_sorting(steps):
    held, m = [], ladders.RunningMedian()
    for value, back in steps:
        if back and held:
            gone = held.pop(value % len(held))
            m.remove(gone)
        else:
            held.append(value)
            m.add(value)
        assert len(m) == len(held)
        if held:
            assert m.value == median(held)


def middle(cluster):
    own = defaultdict(list)
    for z, _, group in cluster:
        own[group].append(z)
    return median(median(v) for v in own.values()), len(own)


def plain_ladder(records):
    """records: (profile, id, group, z); {profile: reference} and {(profile, id): rung}."""
    by_profile = defaultdict(list)
    for p, i, g, z in records:
        by_profile[p].append((z, i, g))
    references, rung = {}, {}
    for p, items in by_profile.items():
        clusters = []
        for item in sorted(items):
            home = next((c for c in clusters if abs(item[0] - middle(c)[0]) <= ladders.TOLERANCE), None)
            if home is None:
                clusters.append([item])
            else:
                home.append(item)
        references[p] = min((-middle(c)[1], middle(c)[0]) for c in clusters)[1]
        for z, i, _ in items:
            k = round(z - references[p])
            rung[p, i] = k if abs(z - (references[p] + k)) <= ladders.TOLERANCE else None
    return references, rung


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clusters_equal_a_plain_scan(spark, seed):
    rng = random.Random(seed)
    rows = []
    for p in "abc":
        for i in range(150):
            z = rng.choice([0.0, 0.13, 0.4, 1.0, 1.15, 2.0]) + rng.choice([0, 0.05, 0.1, -0.02, rng.random() / 3])
            rows.append((p, i, f"g{rng.randrange(1, 60) if rng.random() < 0.6 else i + 100}", z))
    rows += [("one", 1, "g", 3.3), ("two", 1, "g", 1.0), ("two", 2, "h", 2.0)]
    df = spark.createDataFrame(rows, "profile string, id long, evidence string, z double")
    references, rung = plain_ladder(rows)
    assert {r["profile"]: r["reference"] for r in ladders.reference_scales(df).collect()} == pytest.approx(references)
    got = ladders.stepped(df.withColumn("scale", F.pow(F.lit(2.0), "z")).drop("z")).collect()
    assert {(r["profile"], r["id"]): r["rung"] for r in got} == rung and None in rung.values()


def test_zoom_rungs_equal_plain_loops(spark, sf):
    records = more._scales(spark, sf).collect()
    _, rung = plain_ladder([(r["profile"], r["obs_id"], r["evidence"], math.log2(r["scale"])) for r in records])
    members = defaultdict(lambda: defaultdict(list))
    for r in records:
        if rung[r["profile"], r["obs_id"]] is not None:
            members[r["profile"], rung[r["profile"], r["obs_id"]]][r["evidence"]].append(r)
    want = {}
    for key, groups in members.items():
        logs = [median(math.log2(r["scale"]) for r in g) for g in groups.values()]
        center = median(logs)
        two = [median(median(r[c] for r in g) for g in groups.values()) for c in ("dlon_dx", "dlat_dy")]
        want[key] = (2**center, *two, len(groups), median(abs(x - center) for x in logs), sum(map(len, groups.values())), len(groups) >= 3)
    got = {(r["profile"], r["rung"]): tuple(r)[2:] for r in more.zoom_rungs(spark, sf).collect()}
    assert set(got) == set(want) and len(got) > 8
    for key, w in want.items():
        assert got[key] == pytest.approx(w, abs=1e-6)


def test_an_empty_table_has_no_ladder(spark):
    none = spark.createDataFrame([], "profile string, evidence string, scale double")
    assert ladders.rungs(ladders.stepped(none), []).count() == 0
