"""Python data sources: tables of SQLite files, and position reports by named providers, as batches or streams."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

REPORT = "icao24 string, callsign string, time_position long, last_contact long, longitude double, latitude double, baro_altitude double, velocity double, true_track double"


class SqliteTable(DataSource):
    """format("sqlite_table"): options path and table, and the schema to read; the file is opened read-only on the workers,
    so it must lie where they reach it. A missing file or table has no rows. Rows are split by ranges of rowid."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(schema, self.options)


class _SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.columns, self.path, self.table = schema.fieldNames(), options["path"], options["table"]
        self.parts = int(options.get("numPartitions", "8"))

    def _rows(self, sql: str, values: tuple = ()) -> list[tuple]:
        import os
        import sqlite3
        from urllib.parse import quote

        if not os.path.isfile(self.path):
            return []
        connection = sqlite3.connect(f"file:{quote(self.path)}?mode=ro", uri=True, timeout=5.0)
        try:
            return connection.execute(sql, values).fetchall()
        except sqlite3.OperationalError as e:
            if "no such table" in str(e):
                return []
            raise
        finally:
            connection.close()

    def _named(self, name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def partitions(self) -> list[InputPartition]:
        ends = self._rows(f"SELECT min(rowid), max(rowid) FROM {self._named(self.table)}")
        if not ends or ends[0][0] is None:
            return [InputPartition((1, 0))]
        low, high = ends[0]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [InputPartition((i, min(high, i + step - 1))) for i in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        columns = ", ".join(map(self._named, self.columns))
        yield from self._rows(f"SELECT {columns} FROM {self._named(self.table)} WHERE rowid BETWEEN ? AND ? ORDER BY rowid", partition.value)


def _recorded(options, poll: int) -> list[tuple]:
    """Reports of a recorded file of JSON lines with `poll`, the number of the poll that gave them."""
    names = [f.split()[0] for f in REPORT.split(", ")]
    west, south, east, north = map(float, options.get("bbox", "-180,-90,180,90").split(","))
    with open(options["path"], encoding="utf-8") as lines:
        rows = [json.loads(line) for line in lines if line.strip()]
    inside = [r for r in rows if r.get("poll", 0) == poll and west <= r.get("longitude", 999) <= east and south <= r.get("latitude", 999) <= north]
    return [tuple(r.get(n) for n in names) for r in inside]


#: Providers of position reports by name: (options, number of the poll) to rows. Services register themselves here.
PROVIDERS: dict[str, Callable[[dict, int], list[tuple]]] = {"recorded": _recorded}


def provider(name: str) -> Callable[[dict, int], list[tuple]]:
    """A provider by name, in any case."""
    try:
        return PROVIDERS[name.strip().lower()]
    except KeyError:
        raise ValueError(f"no provider {name!r}; there are {', '.join(sorted(PROVIDERS))}") from None


class PositionReports(DataSource):
    """format("position_reports"): options provider (recorded), path, bbox as west,south,east,north, and polls."""

    @classmethod
    def name(cls) -> str:
        return "position_reports"

    def schema(self) -> str:
        return REPORT

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Polls(self.options)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Live(self.options)


class _Polls(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(int(self.options.get("polls", "1")))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from provider(self.options.get("provider", "recorded"))(self.options, partition.value)


class _Live(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        poll = start["poll"]
        last = int(self.options.get("polls", "1"))
        if poll >= last:
            return iter([]), start
        return iter(provider(self.options.get("provider", "recorded"))(self.options, poll)), {"poll": poll + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for poll in range(start["poll"], end["poll"]):
            yield from provider(self.options.get("provider", "recorded"))(self.options, poll)
