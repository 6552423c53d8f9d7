"""Entities over tables: pages, filters, additions and patches of a session."""

import pytest

from contrail.sources.entities import NAMES, Entities

ROWS = [(3, "b", 0, None, [], True), (1, None, 5, 1.5, [1], False), (2, "", 10, 0.0, None, None), (4, "a", None, -1.0, [2], True)]


@pytest.fixture
def entities(spark):
    e = Entities(spark)
    e.source("RouteSegments", spark.createDataFrame(ROWS, "key int, name string, n int, x double, list array<int>, flag boolean"), "key")
    return e


def ids(rows):
    return [r["id"] for r in rows.collect()]


@pytest.mark.parametrize("sort", ["key", "-key", "name", "-name", "n", "-n", "x", "-x", "flag", "-flag", "", "-none", "none"])
def test_pages_are_sorted_by_text_and_stable(entities, sort):
    rows = sorted([dict(zip(("key", "name", "n", "x", "list", "flag"), r, strict=True)) for r in ROWS], key=lambda r: r["key"])
    if sort:
        rows = sorted(rows, key=lambda r: str(r.get(sort.lstrip("-")) or ""), reverse=sort.startswith("-"))
    assert ids(entities.list("RouteSegments", sort)) == [str(r["key"]) for r in rows]
    assert ids(entities.list("RouteSegments", sort, 2)) == [str(r["key"]) for r in rows[:2]]
    assert ids(entities.list("RouteSegments", sort, -3)) == []


def test_filters_additions_and_patches(entities):
    assert ids(entities.filter("RouteSegments", {"flag": True})) == ["3", "4"]
    assert ids(entities.filter("RouteSegments", {"name": None})) == ["1"] and ids(entities.filter("RouteSegments", {"nowhere": 1})) == []
    entities.create("RouteSegments", {"name": "z", "extra": 7})
    entities.create("RouteSegments", {"id": "own", "n": 10})
    made = ids(entities.list("RouteSegments", "", 10))
    assert made[:4] == ["1", "2", "3", "4"] and made[4] == "RouteSegments-0" and made[5] == "own"
    assert ids(entities.filter("RouteSegments", {"n": 10})) == ["2", "own"]
    assert entities.patch("RouteSegments", "2", {"n": 11, "note": "x"})["n"] == 11
    got = entities.get("RouteSegments", "2")
    assert (got["n"], got["note"], got["name"]) == (11, "x", "")
    assert ids(entities.filter("RouteSegments", {"note": "x"})) == ["2"]
    for call in (lambda: entities.get("RouteSegments", "9"), lambda: entities.patch("FR24Captures", "1", {})):
        with pytest.raises(KeyError, match="not found"):
            call()
    with pytest.raises(ValueError, match="no entity"):
        entities.source("Other", entities.rows("RouteSegments"), "id")


def test_every_entity_has_a_name_in_sql(spark, entities):
    views = entities.publish()
    assert len(views) == len(NAMES) == 17
    assert [r["id"] for r in spark.sql("SELECT id FROM entity_RouteSegments_get('3')").collect()] == ["3"]
    got = spark.sql("SELECT id, sort_text FROM entity_RouteSegments_by('n') ORDER BY sort_text DESC, key").collect()
    assert [tuple(r) for r in got] == [("1", "5"), ("2", "10"), ("3", ""), ("4", "")]
    assert spark.sql("SELECT * FROM entity_FR24Captures").count() == 0
    assert {r["entity"]: r["n"] for r in entities.health().collect()} == {n: 4 if n == "RouteSegments" else 0 for n in NAMES}
