"""JSON Schema as Column expressions: a schema document becomes checks over a VARIANT, so that "5" is no number.

Drafts 7 and 2020-12: types, required, properties, additionalProperties, propertyNames, dependentRequired, counts, enum, const,
ranges, lengths, patterns, formats (date-time, date, email, uuid, ipv4), items, prefixItems, contains, uniqueItems, allOf, anyOf,
oneOf, not, if, then and else, and references within the document. What it cannot check it refuses to compile.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import content

#: References that are followed within each other; a value nested deeper is an error of its own.
DEPTH = 6
#: Kinds of a VARIANT by JSON type, and keywords that say nothing about validity.
KINDS = {"object": ("OBJECT",), "array": ("ARRAY",), "string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")}
NOTES = {"$schema", "$id", "$comment", "$defs", "definitions", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "then", "else"}
FORMATS = {
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "email": "@",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "ipv4": r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.|$)){4}(?<!\.)$",
}


def load(address: str) -> dict:
    """A schema document from a file."""
    return json.loads(content(address))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with `value` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID or a kind of number."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _get(value: Column, path: str, to: str) -> Column:
    return F.try_variant_get(value, path, to)


def _member(value: Column, name: str) -> Column:
    if "'" in name:
        return F.element_at(_get(value, "$", "map<string,variant>"), name)
    return _get(value, f"$['{name}']", "variant")


def _equals(value: Column, of: Column, want: Any) -> Column:
    if want is None:
        return of == "VOID"
    if isinstance(want, bool):
        return (of == "BOOLEAN") & (_get(value, "$", "boolean") == want)
    if isinstance(want, (int, float)):
        return of.isin(*KINDS["number"]) & (_get(value, "$", "double") == float(want))
    if isinstance(want, str):
        return (of == "STRING") & (_get(value, "$", "string") == want)
    return F.to_json(value) == json.dumps(want, separators=(",", ":"), sort_keys=True, ensure_ascii=False)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


class _Compiler:
    def __init__(self, root: dict):
        self.root = root

    def _referred(self, address: str) -> Any:
        if not address.startswith("#"):
            raise ValueError(f"only references within the document are followed, not {address!r}")
        found = self.root
        for part in address.lstrip("#").split("/")[1:]:
            part = part.replace("~1", "/").replace("~0", "~")
            found = found[int(part)] if isinstance(found, list) else found[part]
        return found

    def errors(self, value: Column, schema: Any, path: Column, depth: int = 0) -> Column:
        """Array of "path: rule" for a value that is there."""
        none = F.array().cast("array<string>")
        if schema is True or schema == {}:
            return none
        one = lambda rule: F.array(F.concat(path, F.lit(f": {rule}")))
        if schema is False:
            return one("false")
        if unknown := set(schema) - set(self._rules()) - NOTES:
            raise ValueError(f"no check for {', '.join(sorted(unknown))}")
        if depth > DEPTH:
            return one("too deep")

        def of_kind(of: Column) -> Column:
            parts = []
            for word, rule in self._rules().items():
                if word in schema:
                    parts.append(rule(value, of, schema[word], schema, path, depth))
            return F.concat(*parts) if parts else none

        return let(kind(value), of_kind)

    def _rules(self) -> dict[str, Callable]:
        simple = {
            "type": self._type, "enum": lambda v, of, w, _: ~_any([_equals(v, of, x) for x in w]), "const": lambda v, of, w, _: ~_equals(v, of, w),
            "minimum": self._number(lambda d, w: d < w), "maximum": self._number(lambda d, w: d > w),
            "exclusiveMinimum": self._number(lambda d, w: d <= w), "exclusiveMaximum": self._number(lambda d, w: d >= w),
            "multipleOf": self._number(lambda d, w: (d / w) != F.floor(d / w)),
            "minLength": self._string(lambda s, w: F.char_length(s) < w), "maxLength": self._string(lambda s, w: F.char_length(s) > w),
            "pattern": self._string(lambda s, w: ~s.rlike(w)), "format": self._string(self._format),
            "minItems": self._count("ARRAY", lambda n, w: n < w), "maxItems": self._count("ARRAY", lambda n, w: n > w),
            "minProperties": self._count("OBJECT", lambda n, w: n < w), "maxProperties": self._count("OBJECT", lambda n, w: n > w),
            "uniqueItems": lambda v, of, w, _: (of == "ARRAY") & F.lit(bool(w)) & let(F.transform(_get(v, "$", "array<variant>"), lambda x: F.to_json(x)), lambda a: F.size(F.array_distinct(a)) < F.size(a)),
        }

        def flag(word: str, test: Callable) -> Callable:
            return lambda v, of, w, schema, path, depth: F.when(F.coalesce(test(v, of, w, schema), F.lit(False)), F.array(F.concat(path, F.lit(f": {word}")))).otherwise(F.array().cast("array<string>"))

        nested = {
            "required": self._required, "dependentRequired": self._dependent, "properties": self._properties, "additionalProperties": self._additional,
            "propertyNames": self._names, "prefixItems": self._prefix, "items": self._items, "contains": self._contains, "$ref": self._ref,
            "allOf": self._all, "anyOf": self._some, "oneOf": self._one, "not": self._not, "if": self._if,
        }
        return {w: flag(w, t) for w, t in simple.items()} | nested

    @staticmethod
    def _type(value: Column, of: Column, wanted: Any, _: dict) -> Column:
        def fits(name: str) -> Column:
            if name == "integer":
                return of.isin(*KINDS["number"]) & let(_get(value, "$", "double"), lambda d: d == F.floor(d))
            return of.isin(*KINDS[name])

        return ~_any([fits(n) for n in ([wanted] if isinstance(wanted, str) else wanted)])

    @staticmethod
    def _number(test: Callable) -> Callable:
        return lambda v, of, w, _: of.isin(*KINDS["number"]) & let(_get(v, "$", "double"), lambda d: test(d, float(w)))

    @staticmethod
    def _string(test: Callable) -> Callable:
        return lambda v, of, w, _: (of == "STRING") & let(_get(v, "$", "string"), lambda s: test(s, w))

    @staticmethod
    def _count(kind_: str, test: Callable) -> Callable:
        to = "array<variant>" if kind_ == "ARRAY" else "map<string,variant>"
        return lambda v, of, w, _: (of == kind_) & test(F.size(_get(v, "$", to)), w)

    @staticmethod
    def _format(text: Column, name: str) -> Column:
        if name not in FORMATS:
            return F.lit(False)  # a note only
        wrong = ~text.rlike(FORMATS[name])
        if name == "date":
            wrong = wrong | F.try_to_date(text, "yyyy-MM-dd").isNull()
        if name == "date-time":
            wrong = wrong | F.upper(text).try_cast("timestamp").isNull()
        return wrong

    def _inside(self, of: Column, wanted: str, found: Callable[[], Column]) -> Column:
        return F.when(of == wanted, found()).otherwise(F.array().cast("array<string>"))

    def _required(self, value, of, names, schema, path, depth):
        each = [F.when(_member(value, n).isNull(), F.concat(path, F.lit(f".{n}: required"))) for n in names]
        return self._inside(of, "OBJECT", lambda: F.array_compact(F.array(*each).cast("array<string>")))

    def _dependent(self, value, of, needs, schema, path, depth):
        each = [F.when(_member(value, a).isNotNull() & _member(value, n).isNull(), F.concat(path, F.lit(f".{n}: dependentRequired"))) for a, ns in needs.items() for n in ns]
        return self._inside(of, "OBJECT", lambda: F.array_compact(F.array(*each).cast("array<string>")))

    def _there(self, child: Column, schema: Any, path: Column, depth: int) -> Column:
        return let(child, lambda c: F.when(c.isNotNull(), self.errors(c, schema, path, depth)).otherwise(F.array().cast("array<string>")))

    def _properties(self, value, of, members, schema, path, depth):
        each = [self._there(_member(value, n), s, F.concat(path, F.lit(f".{n}")), depth) for n, s in members.items()]
        return self._inside(of, "OBJECT", lambda: F.concat(*each) if each else F.array().cast("array<string>"))

    def _additional(self, value, of, more, schema, path, depth):
        known = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")

        def found() -> Column:
            members = F.map_entries(_get(value, "$", "map<string,variant>"))
            extra = F.filter(members, lambda m: ~F.array_contains(known, m["key"]))
            if more is False:
                return F.array_sort(F.transform(extra, lambda m: F.concat(path, F.lit("."), m["key"], F.lit(": additionalProperties"))))
            return F.flatten(F.transform(extra, lambda m: self.errors(m["value"], more, F.concat(path, F.lit("."), m["key"]), depth)))

        return self._inside(of, "OBJECT", found)

    def _names(self, value, of, rule, schema, path, depth):
        names = lambda: F.map_keys(_get(value, "$", "map<string,variant>"))
        as_value = lambda n: F.parse_json(F.concat(F.lit('"'), F.regexp_replace(n, r'(["\\])', r"\\$1"), F.lit('"')))
        return self._inside(of, "OBJECT", lambda: F.flatten(F.transform(names(), lambda n: let(as_value(n), lambda v: self.errors(v, rule, F.concat(path, F.lit("."), n), depth)))))

    def _listed(self, value: Column) -> Column:
        return _get(value, "$", "array<variant>")

    def _prefix(self, value, of, rules, schema, path, depth):
        each = [self._there(_get(value, f"$[{i}]", "variant"), s, F.concat(path, F.lit(f"[{i}]")), depth) for i, s in enumerate(rules)]
        return self._inside(of, "ARRAY", lambda: F.concat(*each))

    def _items(self, value, of, rule, schema, path, depth):
        if isinstance(rule, list):  # draft 7's way of listing rules for the first items
            return self._prefix(value, of, rule, schema, path, depth)
        first = len(schema.get("prefixItems", ()))
        at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        one = lambda x, i: F.when(i >= first, self.errors(x, rule, at(i), depth)).otherwise(F.array().cast("array<string>"))
        return self._inside(of, "ARRAY", lambda: F.flatten(F.transform(self._listed(value), one)))

    def _contains(self, value, of, rule, schema, path, depth):
        none = lambda: ~F.exists(self._listed(value), lambda x: F.size(self.errors(x, rule, path, depth)) == 0)
        return self._inside(of, "ARRAY", lambda: F.when(none(), F.array(F.concat(path, F.lit(": contains")))).otherwise(F.array().cast("array<string>")))

    def _ref(self, value, of, address, schema, path, depth):
        return self.errors(value, self._referred(address), path, depth + 1)

    def _all(self, value, of, rules, schema, path, depth):
        return F.concat(*[self.errors(value, r, path, depth) for r in rules])

    def _fitting(self, value: Column, rules: list, path: Column, depth: int) -> Column:
        out = F.lit(0)
        for r in rules:
            out = out + (F.size(self.errors(value, r, path, depth)) == 0).cast("int")
        return out

    def _said(self, wrong: Column, word: str, path: Column) -> Column:
        return F.when(wrong, F.array(F.concat(path, F.lit(f": {word}")))).otherwise(F.array().cast("array<string>"))

    def _some(self, value, of, rules, schema, path, depth):
        return self._said(self._fitting(value, rules, path, depth) == 0, "anyOf", path)

    def _one(self, value, of, rules, schema, path, depth):
        return self._said(self._fitting(value, rules, path, depth) != 1, "oneOf", path)

    def _not(self, value, of, rule, schema, path, depth):
        return self._said(self._fitting(value, [rule], path, depth) == 1, "not", path)

    def _if(self, value, of, rule, schema, path, depth):
        then, otherwise = (self.errors(value, schema.get(w, True), path, depth) for w in ("then", "else"))
        return F.when(self._fitting(value, [rule], path, depth) == 1, then).otherwise(otherwise)


def errors(value: Column, schema: dict) -> Column:
    """What is wrong with a VARIANT by a schema document, as "path: rule" in the document's order of rules; "$: not JSON" for null."""
    found = _Compiler(schema).errors(value, schema, F.lit("$"))
    return F.when(value.isNull(), F.array(F.lit("$: not JSON"))).otherwise(found)


def mentions(value: Column, words: list[str]) -> Column:
    """Whether a text anywhere in a VARIANT, but for names of members, is one of `words`, whatever its case and spaces around it."""
    some = "|".join(r"\Q" + w.lower().replace("\\E", "") + r"\E" for w in words)
    return F.lower(F.to_json(value)).rlike(rf'[\[:,]\s*"\s*({some})\s*"\s*[\],}}]') | F.lower(F.to_json(value)).rlike(rf'^"\s*({some})\s*"$')


def validated(rows: DataFrame, body: str, schema: dict, prohibited: list[str] | None = None) -> DataFrame:
    """`rows` with `errors`, what is wrong with the JSON text `body`; none for a valid record."""
    parsed = F.try_parse_json(body)
    found = errors(F.col("_v"), schema)
    if prohibited:
        found = F.concat(found, F.when(mentions(F.col("_v"), prohibited), F.array(F.lit("$: prohibited label"))).otherwise(F.array().cast("array<string>")))
    return rows.withColumn("_v", parsed).withColumn("errors", found).drop("_v")
