"""Every registered query of the domain operators with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bundles, cards, entities, evidence, exchange, fusion, grids, matching, more, pictures, places, records, review, rollups, schemas, scorers

_PARTS = (fusion, matching, rollups, evidence, review, cards, places, exchange, scorers, records, more, grids, schemas, bundles, entities, pictures)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
ORACLE: dict[str, str] = {k: v for p in _PARTS for k, v in p.ORACLE.items()}
