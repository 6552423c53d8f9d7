"""Named entities over tables: listed, filtered, fetched, added to and patched, from Python and from SQL.

Every entity has an `id` and a place in its own order. Sorting is by the text of a column, in which nothing, false, zero and
empty values are the empty text; equal texts stay in the entity's order. What a session adds and patches lies over the
tables and is never written to them.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The entities that there are, and how many rows a page has unless told.
NAMES = (
    "PRAirports", "AirspaceObservations", "ExportPackages", "ReadinessReports", "AnalysisLenses", "AnalysisObjectives", "LensCoverage", "AircraftProfiles",
    "RLSMSpatialObservations", "RLSMSpatialFrames", "RLSMZoomRungs", "FR24Captures", "RouteSegments", "InfrastructureAssets", "AirspaceAssetLinks",
    "ManualReviewItems", "FederationSyncEvents",
)
PAGE = 500


def sort_text(column: Column, kind: str) -> Column:
    """A column's text for sorting: empty for whatever is nothing, false, zero or empty."""
    if kind in ("boolean",):
        return F.when(column, F.lit("True")).otherwise("")
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.when(column != 0, column.cast("string")).otherwise("")
    if kind.startswith(("array", "map")):
        return F.when(F.size(column) > 0, F.to_json(column)).otherwise("")
    if kind.startswith("struct"):
        return F.coalesce(F.to_json(column), F.lit(""))
    return F.coalesce(column.cast("string"), F.lit(""))


class Entities:
    """Entities of a session, by name; those without a source are empty."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[str, tuple[DataFrame, list[Column]]] = {}
        self._created: dict[str, list[dict]] = {}
        self._patches: dict[str, dict[str, dict]] = {}

    def source(self, name: str, rows: DataFrame, key: str, order: list[Column] | None = None) -> None:
        """Gives an entity its rows, with `key` as their id, in the order of `order` or of the key."""
        if name not in NAMES:
            raise ValueError(f"no entity {name!r}; there are {', '.join(NAMES)}")
        made = rows if "id" in rows.columns else rows.withColumn("id", F.col(key).cast("string"))
        self._tables[name] = made.withColumn("id", F.col("id").cast("string")), order or [F.col(key)]

    def _base(self, name: str) -> tuple[DataFrame, list[Column]]:
        empty = lambda: self.spark.createDataFrame([], "id string")
        return self._tables[name] if name in self._tables else (empty(), [F.col("id")])

    def rows(self, name: str) -> DataFrame:
        """An entity's rows, with what the session has added and patched; `_at` is their place: the table's first, then added ones."""
        base, order = self._base(name)
        out = base.withColumn("_at", F.struct(F.lit(0).alias("late"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("o")))
        at = out.schema["_at"].dataType
        added = self._created.get(name, [])  # what a session's user has typed in
        if added:
            named = [(f.name, f.dataType.simpleString()) for f in base.schema]
            known = {n for n, _ in named}
            new = sorted({k for r in added for k in r} - known)
            kinds = ", ".join(["`_i` int", *[f"`{n}` {t}" for n, t in named], *[f"`{n}` string" for n in new]])
            text = lambda v: None if v is None else str(v)
            data = [(i, *[r.get(n) for n, _ in named], *[text(r.get(n)) for n in new]) for i, r in enumerate(added, 1)]
            place = F.struct(F.col("_i").alias("late"), F.lit(None).cast(at["o"].dataType).alias("o"))
            rows = self.spark.createDataFrame(data, kinds).withColumn("_at", place).drop("_i")
            out = out.unionByName(rows, allowMissingColumns=True)
        for id_, patch in self._patches.get(name, {}).items():
            for column, value in patch.items():
                kind = out.schema[column].dataType if column in out.columns else "string"
                old = F.col(column) if column in out.columns else F.lit(None).cast("string")
                out = out.withColumn(column, F.when(F.col("id") == id_, F.lit(value).cast(kind)).otherwise(old))
        return out

    def _page(self, rows: DataFrame, sort: str, limit: int) -> DataFrame:
        by = [F.col("_at").asc()]
        name = sort.lstrip("-")
        if sort and name in rows.columns:
            text = sort_text(F.col(name), rows.schema[name].dataType.simpleString())
            by = [text.desc() if sort.startswith("-") else text.asc(), *by]
        return rows.orderBy(*by).limit(max(limit, 0)).drop("_at")

    def list(self, name: str, sort: str = "-created_date", limit: int = PAGE) -> DataFrame:
        """The first rows by a column, from its end with a minus sign before; a name that is no column leaves the order."""
        return self._page(self.rows(name), sort, limit)

    def filter(self, name: str, filters: dict[str, Any] | None = None, sort: str = "", limit: int = PAGE) -> DataFrame:
        """Rows whose columns equal the given values; None is met by nulls, and by a column that is not there."""
        rows = self.rows(name)
        for column, value in (filters or {}).items():
            rows = rows.where(F.col(column).eqNullSafe(F.lit(value)) if column in rows.columns else F.lit(value is None))
        return self._page(rows, sort, limit or PAGE)

    def get(self, name: str, id_: str) -> dict:
        """The first row with an id; an error if there is none."""
        found = self.rows(name).where(F.col("id") == id_).orderBy("_at").drop("_at").first()
        if found is None:
            raise KeyError(f"{name} not found: {id_}")
        return found.asDict(recursive=True)

    def create(self, name: str, row: dict) -> dict:
        """Adds a row for this session; it gets an id if it has none, and is marked."""
        made = {"id": f"{name}-{len(self._created.get(name, []))}", "_session_only": True} | row
        self._created.setdefault(name, []).append(made)
        return made

    def patch(self, name: str, id_: str, values: dict) -> dict:
        """Lays values over a row for this session; an error if there is none."""
        row = self.get(name, id_)
        self._patches.setdefault(name, {}).setdefault(id_, {}).update(values)
        return row | values

    def health(self) -> DataFrame:
        """How many rows each entity has, those without a source among them."""
        counts = [self.rows(n).agg(F.lit(n).alias("entity"), F.count("*").alias("n")) for n in NAMES if n in self._tables or n in self._created]
        rest = [n for n in NAMES if n not in self._tables and n not in self._created]
        out = self.spark.createDataFrame([(n, 0) for n in rest], "entity string, n long")
        for c in counts:
            out = out.unionByName(c)
        return out

    def publish(self, prefix: str = "entity_") -> list[str]:
        """SQL names for every entity: the view `entity_X`, and the table functions `entity_X_get(id)` and `entity_X_by(column)`, whose
        rows bear `sort_text`, the text that the column sorts by. Gives the names of the views."""
        made = []
        for name in NAMES:
            rows = self.rows(name).drop("_at")
            view = f"{prefix}{name}"
            rows.createOrReplaceTempView(view)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            chosen = ", ".join(f"`{c}`" for c in rows.columns)
            texts = rows.withColumn("_texts", F.create_map(*[x for f in rows.schema for x in (F.lit(f.name), sort_text(F.col(f.name), f.dataType.simpleString()))]))
            texts.createOrReplaceTempView(f"{view}_texts")
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {view}_get(wanted STRING) RETURNS TABLE ({columns}) RETURN SELECT {chosen} FROM {view} WHERE id = {view}_get.wanted")
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {view}_by(name STRING) RETURNS TABLE ({columns}, sort_text STRING) RETURN SELECT {chosen}, coalesce(_texts[{view}_by.name], '') FROM {view}_texts")
            made.append(view)
        return made


