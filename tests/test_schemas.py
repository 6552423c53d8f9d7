"""JSON Schema compiled to Column checks, rule by rule."""

import json

import pytest
from pyspark.sql import functions as F

from contrail.functions import schemas
from contrail.plans import schemas as plans

TREE = {"type": "object", "properties": {"n": {"type": "integer"}, "next": {"$ref": "#"}}}
CASES = [
    ({}, "1", []),
    (False, "1", ["$: false"]),
    ({"type": "number"}, '"5"', ["$: type"]),
    ({"type": "number"}, "5", []),
    ({"type": "integer"}, "5.0", []),
    ({"type": "integer"}, "5e1", []),
    ({"type": "integer"}, "5.5", ["$: type"]),
    ({"type": "integer"}, "true", ["$: type"]),
    ({"type": "boolean"}, "1", ["$: type"]),
    ({"type": ["string", "null"]}, "null", []),
    ({"type": "object"}, "[]", ["$: type"]),
    ({"type": "array"}, "[1]", []),
    ({"enum": ["a", 1, None, True]}, "1.0", []),
    ({"enum": ["a", 1, None]}, "true", ["$: enum"]),
    ({"enum": ["a", [1, 2]]}, "[1, 2]", []),
    ({"const": {"b": 1, "a": "x"}}, '{"a": "x", "b": 1}', []),
    ({"const": "none"}, '"None"', ["$: const"]),
    ({"minimum": 2, "maximum": 3}, "2", []),
    ({"minimum": 2}, "1.9", ["$: minimum"]),
    ({"minimum": 2}, '"1"', []),
    ({"exclusiveMinimum": 2}, "2", ["$: exclusiveMinimum"]),
    ({"exclusiveMaximum": 2}, "2", ["$: exclusiveMaximum"]),
    ({"multipleOf": 3}, "7", ["$: multipleOf"]),
    ({"minLength": 2, "maxLength": 2}, '"😀é"', []),
    ({"minLength": 2}, '"😀"', ["$: minLength"]),
    ({"maxLength": 1}, '"ab"', ["$: maxLength"]),
    ({"pattern": "b"}, '"abc"', []),
    ({"pattern": "^b"}, '"abc"', ["$: pattern"]),
    ({"format": "date"}, '"2024-02-30"', ["$: format"]),
    ({"format": "date"}, '"2024-02-29"', []),
    ({"format": "date-time"}, '"2024-02-29T10:00:00.5+04:00"', []),
    ({"format": "date-time"}, '"2024-02-29 10:00"', ["$: format"]),
    ({"format": "date-time"}, '"2024-02-30T10:00:00Z"', ["$: format"]),
    ({"format": "ipv4"}, '"1.2.3.256"', ["$: format"]),
    ({"format": "ipv4"}, '"1.2.3.255"', []),
    ({"format": "uuid"}, '"no"', ["$: format"]),
    ({"format": "color"}, '"no"', []),
    ({"required": ["a", "b"]}, '{"a": null}', ["$.b: required"]),
    ({"required": ["a"]}, "[]", []),
    ({"dependentRequired": {"a": ["b"]}}, '{"a": 1}', ["$.b: dependentRequired"]),
    ({"properties": {"a'b": {"type": "string"}, "c d": {"type": "string"}}}, '{"a\'b": 1, "c d": 2}', ["$.a'b: type", "$.c d: type"]),
    ({"properties": {"a": {}}, "additionalProperties": False}, '{"z": 1, "a": 1, "b": 2}', ["$.b: additionalProperties", "$.z: additionalProperties"]),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "string"}}, '{"a": 1, "b": 2, "c": "x"}', ["$.b: type"]),
    ({"propertyNames": {"pattern": "^[a-z]$"}}, '{"a": 1, "B\\"": 2}', ['$.B": pattern']),
    ({"minProperties": 2}, '{"a": 1}', ["$: minProperties"]),
    ({"items": {"type": "string"}}, '["a", 1, [2]]', ["$[1]: type", "$[2]: type"]),
    ({"items": {"items": {"minimum": 2}}}, "[[1, 2], [3, 0]]", ["$[0][0]: minimum", "$[1][1]: minimum"]),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "number"}}, '[1, "x", 2]', ["$[0]: type", "$[1]: type"]),
    ({"items": [{"type": "string"}]}, '[1, "x"]', ["$[0]: type"]),
    ({"minItems": 1}, "[]", ["$: minItems"]),
    ({"maxItems": 1}, "[1, 2]", ["$: maxItems"]),
    ({"uniqueItems": True}, '[{"a": 1, "b": 2}, {"b": 2, "a": 1}]', ["$: uniqueItems"]),
    ({"uniqueItems": True}, '[1, "1", true]', []),
    ({"contains": {"type": "string"}}, "[1, 2]", ["$: contains"]),
    ({"contains": {"type": "string"}}, '[1, "x"]', []),
    ({"allOf": [{"minimum": 2}, {"type": "string"}]}, "1", ["$: minimum", "$: type"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, "1", ["$: anyOf"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, "4", []),
    ({"oneOf": [{"minimum": 1}, {"minimum": 3}]}, "4", ["$: oneOf"]),
    ({"oneOf": [{"minimum": 1}, {"minimum": 3}]}, "2", []),
    ({"not": {"type": "string"}}, '"x"', ["$: not"]),
    ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"minimum": 5}}, '"x"', ["$: minLength"]),
    ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"minimum": 5}}, "1", ["$: minimum"]),
    ({"properties": {"a": {"$ref": "#/$defs/x~1y"}}, "$defs": {"x/y": {"type": "null"}}}, '{"a": 1}', ["$.a: type"]),
    (TREE, '{"n": 1, "next": {"n": 2, "next": {"n": "x"}}}', ["$.next.next.n: type"]),
    ({"type": "string", "title": "t", "description": "d"}, "nonsense", ["$: not JSON"]),
    ({"type": "string"}, None, ["$: not JSON"]),
    ({"type": "object"}, '{"a": 1, "a": 2}', ["$: not JSON"]),
]


@pytest.fixture(scope="module")
def found(spark):
    """What every case gives, in a few jobs."""
    out = []
    for i in range(0, len(CASES), 17):
        part = CASES[i : i + 17]
        rows = spark.createDataFrame([(j, c[1]) for j, c in enumerate(part)], "i int, body string").withColumn("v", F.try_parse_json("body"))
        each = F.array(*[schemas.errors(F.col("v"), c[0]) if c[0] is not False else F.array(F.lit("$: false")) for c in part])
        out += [r["e"] for r in rows.select("i", F.get(each, F.col("i")).alias("e")).orderBy("i").collect()]
    return out


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{i}-{json.dumps(c[0])[:40]}" for i, c in enumerate(CASES)])
def test_a_rule(found, i):
    assert found[i] == CASES[i][2]


def test_nesting_beyond_the_depth_is_an_error(spark):
    deep = json.loads('{"n": 1}')
    for _ in range(9):
        deep = {"next": deep}
    rows = spark.createDataFrame([(json.dumps(deep),)], "body string").select(schemas.errors(F.try_parse_json("body"), TREE).alias("e"))
    assert rows.first()["e"] == ["$" + ".next" * 7 + ": too deep"]


def test_what_cannot_be_checked_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="patternProperties"):
        schemas.errors(F.col("v"), {"patternProperties": {}})
    with pytest.raises(ValueError, match="within the document"):
        schemas.errors(F.col("v"), {"$ref": "http://x/y"})
    (tmp_path / "s.json").write_text(json.dumps(plans.SESSION))
    assert schemas.load(str(tmp_path / "s.json")) == plans.SESSION


def test_labels_are_found_in_values_only(spark):
    bodies = ['{"a": [" Accepted "]}', '{"accepted": 1}', '"ACCEPTED"', '{"a": "not accepted"}', '{"a": "x: \\"accepted\\", y"}', '{"a": {"b": "accepted"}, "c": 1}', "3"]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string")
    got = rows.select("i", schemas.mentions(F.try_parse_json("b"), ["accepted", "a.b"]).alias("m")).collect()
    assert {r["i"] for r in got if r["m"]} == {0, 2, 5}
