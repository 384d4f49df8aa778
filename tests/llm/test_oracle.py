"""Queries that SQL can express against their SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SMALL

from seasongrid.llm import queries


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    relation = duck.sql(queries.ORACLE_SQL[name])
    assert set(df.columns) == set(relation.columns)
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in df.schema.fields} == dict(zip(relation.columns, map(str, relation.types), strict=True))
    got = sorted(tuple(r[c] for c in relation.columns) for r in df.collect())
    assert got and got == sorted(relation.fetchall())
