"""Every registered query equals its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def comparable(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.astype(object).where(frame.notna(), None).itertuples(index=False):
        rows.append(tuple(str(pd.Timestamp(v).date()) if hasattr(v, "year") else v for v in row))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = registry.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in result.collect()]
    found = pd.DataFrame(rows, columns=result.columns, dtype=object)
    relation = duck.sql(registry.oracle_sql()[name])
    expected = pd.DataFrame(relation.fetchall(), columns=relation.columns, dtype=object)
    assert sorted(found.columns) == sorted(expected.columns)
    assert len(found) == len(expected)
    assert comparable(found) == comparable(expected)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
    assert set(registry.session_sql()) == set(registry.QUERIES)
    assert set(registry.oracle_sql()) <= set(registry.queries())
