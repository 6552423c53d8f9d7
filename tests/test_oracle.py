"""Every registered domain query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from contrail.plans import catalog


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0) if math.isfinite(v) else str(v)
    return str(v)


def test_every_query_has_sql_but_those_tested_against_brute_force():
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"aircraft_communities", "fuzzy_tails", "terrain_measures", "track_shapes", "zoom_rungs"} and set(catalog.ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, sf, con, name):
    got = catalog.QUERIES[name](spark, sf)
    want = con.sql(catalog.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    assert mine == theirs
