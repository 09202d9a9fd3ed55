"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemill.registry import entries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    left, right = rows(got.columns, got.collect()), rows(names, want.fetchall())
    assert sum(left.values()) > 0
    assert not (left - right), list((left - right))[:3]
    assert not (right - left), list((right - left))[:3]


def test_every_query_has_an_oracle():
    assert set(entries()) <= set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert len(result.columns) == 34
    assert result.count() > 0
