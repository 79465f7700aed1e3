"""Every record query that has SQL gives the same rows as DuckDB on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from quillstone.plans.oracle import ORACLE_SQL
from quillstone.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
