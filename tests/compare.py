"""Spark rows against DuckDB rows: names, types and values, in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
}


def assert_same(spark_df, connection, sql):
    relation = connection.sql(sql)
    expected_types = {
        name: SPARK_TYPES[str(kind)] for name, kind in zip(relation.columns, relation.types)
    }
    assert dict(spark_df.dtypes) == expected_types
    expected = _rows(relation.columns, relation.fetchall())
    actual = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    assert len(actual) == len(expected)
    different = [pair for pair in zip(actual, expected) if pair[0] != pair[1]]
    assert not different, different[:3]
