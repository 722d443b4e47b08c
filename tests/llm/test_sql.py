"""Queries that SQL can express, against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from riskrank.llm import queries

SF = Path("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", ["op8_warc_salvage", "op12_site_templates", "op13_veb_manifest"])
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in SF.glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    result = queries.queries()[name](spark, str(SF))
    expected = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(result.columns)
    want = sorted((tuple(map(str, r)) for r in expected.fetchall()))
    assert sorted((tuple(str(r[n]) for n in names) for r in result.collect())) == want and want
