"""Comparison of a Spark result with the result of the equivalent SQL on DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def rows_of(columns, records) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(record[i] for i in order) for record in records)


def differences(frame, connection, sql: str) -> str | None:
    """None if columns, types and rows agree, regardless of order; else what differs."""
    columns, spark_rows = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected_columns, sql_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    known = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    for name, spark_type in frame.dtypes:
        if known.get(spark_type, spark_type) != types[name]:
            return f"type of {name}: {spark_type} and {types[name]}"
    if not sql_rows and "closed" not in sql:
        return "no rows"
    if spark_rows != sql_rows:
        extra, lacking = spark_rows - sql_rows, sql_rows - spark_rows
        return f"{extra.total()} rows extra, as {list(extra)[:3]}; {lacking.total()} lacking, as {list(lacking)[:3]}"
    return None
