"""Run a query in Spark and its SQL twin in DuckDB, and compare."""

from __future__ import annotations

import math
import re
from pathlib import Path

import duckdb

import __spark_entry__

TABLES = ["nation", "customer", "part", "orders", "lineitem", "events"]

#: The queries with a twin; the optional ones have tests of their own.
QUERIES = {
    name: query
    for name, query in __spark_entry__.queries().items()
    if name != "pipeline" and not re.match(r"op\d+_", name)
}
ORACLES = {name: sql for name, sql in __spark_entry__.oracle_sql().items() if name in QUERIES}

# Spark type -> DuckDB types that hold the same values.
SAME_TYPES = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
}


def oracle_rows(sql: str, folder: str) -> tuple[list[tuple[str, str]], list[tuple]]:
    """Columns with types, and rows, both in column-name order."""
    with duckdb.connect() as db:
        for table in TABLES:
            path = Path(folder) / f"{table}.parquet"
            files = path / "*.parquet" if path.is_dir() else path
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
        cursor = db.execute(sql)
        columns = [(column[0], str(column[1])) for column in cursor.description]
        rows = cursor.fetchall()
    return _by_name(columns, rows)


def spark_rows(df) -> tuple[list[tuple[str, str]], list[tuple]]:
    return _by_name(df.dtypes, [tuple(row) for row in df.collect()])


def _by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i][0])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: [(v is not None, str(v)) for v in row]
    )


def differences(df, sql: str, folder: str) -> list[str]:
    spark_columns, actual = spark_rows(df)
    oracle_columns, expected = oracle_rows(sql, folder)
    if [name for name, _ in spark_columns] != [name for name, _ in oracle_columns]:
        return [f"columns {spark_columns} != {oracle_columns}"]
    problems = [
        f"type of {name}: {spark_type} != {oracle_type}"
        for (name, spark_type), (_, oracle_type) in zip(spark_columns, oracle_columns, strict=True)
        if oracle_type not in SAME_TYPES[spark_type]
    ]
    if len(actual) != len(expected):
        return [*problems, f"{len(actual)} rows != {len(expected)}"]
    unequal = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    if any(isinstance(v, float) and math.isnan(v) for row in actual for v in row):
        problems.append("NaN in result")
    if unequal:
        problems.append(f"{len(unequal)} of {len(actual)} rows differ, first: {unequal[0]}")
    return problems
