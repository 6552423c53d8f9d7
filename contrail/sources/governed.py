"""Governed values: a registry whose entries say whether they may be executed, and rows that say which of them made them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statuses that may be executed, and the one that never may.
EXECUTABLE = ("EXECUTABLE_CANDIDATE", "VALIDATED", "CANONICAL")
PROHIBITED = "PROHIBITED"
#: Entries of a registry, which is held by the driver.
MOST = 10_000
STAMP = "array<struct<threshold_id:string,value:string,status:string,version:string>>"


class NotExecutable(RuntimeError):
    """A value that its registry does not allow to be executed."""


def number(text: str) -> int | float | str:
    """A value as a whole number or a number if it is one, else its text."""
    text = text.strip()
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


class Thresholds:
    """The entries of a registry (threshold_id, current_value, status, failure_behavior, effective_version) by id; of an id that
    stands there twice the last by version counts. A value is refused while a plan is built, not while it runs."""

    def __init__(self, rows: DataFrame):
        columns = ["threshold_id", "current_value", "status", "failure_behavior", "effective_version"]
        named = [(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in rows.columns else F.lit("")).alias(c) for c in columns]
        found = rows.select(*named).limit(MOST + 1).collect()
        if len(found) > MOST:
            raise ValueError(f"a registry has at most {MOST} entries")
        self.entries = {r["threshold_id"]: r for r in sorted(found, key=lambda r: r["effective_version"])}

    def entry(self, id_: str):
        """An entry; an error if the registry has none."""
        if id_ not in self.entries:
            raise KeyError(f"threshold {id_!r} is not registered")
        return self.entries[id_]

    def refusal(self, id_: str) -> str | None:
        """Why an entry may not be executed, or nothing."""
        e = self.entry(id_)
        if e["status"] == PROHIBITED:
            return f"{id_} is PROHIBITED and must never execute. Failure behavior on record: {e['failure_behavior']}"
        return None if e["status"] in EXECUTABLE else f"{id_} has status {e['status']}, which is not executable"

    def value(self, id_: str) -> Column:
        """An executable value as a Column, whose metadata say where it is from; an error for any other."""
        if why := self.refusal(id_):
            raise NotExecutable(why)
        e = self.entry(id_)
        return F.lit(number(e["current_value"])).alias(id_, metadata={"threshold_id": id_, "status": e["status"], "version": e["effective_version"]})

    def stamps(self, *ids: str) -> Column:
        """What a row bears that these values have made: their ids, values, statuses and versions, in the order asked."""
        each = []
        for id_ in ids:
            e = self.entry(id_)
            each.append(F.struct(F.lit(id_).alias("threshold_id"), F.lit(e["current_value"]).alias("value"), F.lit(e["status"]).alias("status"), F.lit(e["effective_version"]).alias("version")))
        return F.array(*each).cast(STAMP)


def scored(rows: DataFrame, registry: Thresholds, ids: list[str], score) -> DataFrame:
    """`rows` with the columns that `score` makes of the values of `ids`, a name to a Column, and `provenance`, the values' stamps."""
    values = {i: registry.value(i) for i in ids}
    return rows.withColumns(score(values)).withColumn("provenance", registry.stamps(*ids))


def dangling(profiles: DataFrame, lenses: DataFrame) -> DataFrame:
    """Rows (profile_id, lens_id): what profiles (profile_id, required_lenses, optional_lenses) name that no lens (lens_id) is."""
    names = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    asked = profiles.select("profile_id", F.explode(F.concat(names("required_lenses"), names("optional_lenses"))).alias("lens_id"))
    return asked.join(lenses.select("lens_id").distinct(), "lens_id", "left_anti").select("profile_id", "lens_id")
