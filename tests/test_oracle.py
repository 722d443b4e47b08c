"""Every registered query against its SQL counterpart in DuckDB, on the smallest tables."""

import math
import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
# The llm subpackage, where it is present, is tested in its own folder.
QUERIES = {k: v for k, v in contract.queries().items() if k != "pipeline" and not re.match(r"op\d+_", k)}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not available")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, str(SF_DIR))
    got = rows_of(result.columns, result.collect())
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    assert got == rows_of(names, expected.fetchall())
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_query_gives_rows(spark, name):
    result = QUERIES[name](spark, str(SF_DIR))
    rows = result.collect()
    assert rows
    for r in rows:
        if "score" in result.columns:
            assert 0.0 <= r.score <= 1.0
        if "measure" in result.columns:
            assert 0.0 <= r.value <= 1.0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.cutoff for r in sorted(rows)] == sorted(contract.CUTOFFS)
