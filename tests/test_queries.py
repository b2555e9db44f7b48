"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from railwatch.plans.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def test_each_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == set()
    assert set(ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    result = entry_points.queries()[name](spark, str(SF))
    columns = sorted(result.columns)
    got = sorted((tuple(plain(v) for v in r) for r in result.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sql.execute(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted((tuple(plain(v) for v in r) for r in expected), key=repr)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
