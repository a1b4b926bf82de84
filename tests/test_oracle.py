"""Every query against its SQL equivalent in DuckDB."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pitwall.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_equivalent():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_and_types(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    result = duck.execute(oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    columns = sorted(types)
    places = [list(types).index(column) for column in columns]
    expected = sorted((tuple(row[i] for i in places) for row in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == expected
    assert expected or name == "src_empty_selection"


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["team_name", "total_laps", "avg_lap_time", "best_lap"]
    assert result.count() == 8
