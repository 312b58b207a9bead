"""Run a query and its SQL on the same tables and compare columns, types and every value."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Spark type -> DuckDB type of the same values
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(row) for row in rows), key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark: SparkSession, folder: str, query, sql: str, connection) -> str | None:
    """None when equal, otherwise what differs first."""
    result = query(spark, folder)
    names = sorted(result.columns)
    expected = connection.sql(sql)
    if names != sorted(expected.columns):
        return f"columns {names} != {sorted(expected.columns)}"
    expected = expected.select(*[duckdb.ColumnExpression(name) for name in names])
    types = dict(zip(expected.columns, map(str, expected.types)))
    for field in result.schema:
        if TYPES.get(field.dataType.simpleString()) != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
    mine, theirs = sorted_rows(result.select(*names).collect()), sorted_rows(expected.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for one, other in zip(mine, theirs):
        if one != other:
            return f"{dict(zip(names, one))} != {dict(zip(names, other))}"
    return None
