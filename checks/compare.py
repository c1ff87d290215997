"""Compare a Spark result with its DuckDB result, value by value."""

from __future__ import annotations

import os

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _kind(kind: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(kind) or pa.types.is_string(kind) else str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    columns = sorted(table.column_names)
    values = zip(*[table.column(c).to_pylist() for c in columns])
    return sorted((tuple(v) for v in values), key=lambda row: tuple((x is not None, str(type(x)), x) if x is not None else (False, "", 0) for x in row))


def differences(spark_result: pa.Table, expected: pa.Table) -> list[str]:
    """Empty if names, types, row counts and every value are equal."""
    found = []
    kinds = {f.name: _kind(f.type) for f in spark_result.schema}
    wanted = {f.name: _kind(f.type) for f in expected.schema}
    if kinds != wanted:
        found.append(f"schema {kinds} is not {wanted}")
        if set(kinds) != set(wanted):
            return found
    if spark_result.num_rows != expected.num_rows:
        found.append(f"{spark_result.num_rows} rows, expected {expected.num_rows}")
        return found
    wrong = [(a, b) for a, b in zip(_rows(spark_result), _rows(expected)) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
