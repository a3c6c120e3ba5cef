"""Every query of the record operators against its DuckDB text."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from folioforge.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_rows_as_duckdb(spark, duck, name):
    query, sql = QUERIES[name]
    frame = query(spark, FOLDER)
    columns = sorted(frame.columns)
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(str([plain(row[names.index(c)]) for c in columns]) for row in result.fetchall())
    assert sorted(str([plain(v) for v in row]) for row in frame.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql])
def test_queries_without_sql_run(spark, name):
    QUERIES[name][0](spark, FOLDER).collect()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
