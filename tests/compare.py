"""Run a query on both engines and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def same_rows(left, right) -> str | None:
    """None when both lists hold the same rows, else the first difference."""
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(sorted(left, key=_key), sorted(right, key=_key)):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12):
                    return f"{a} against {b}"
            elif x != y or type(x) is not type(y):
                return f"{a} against {b}"
    return None


def compare(frame, connection, sql: str) -> str | None:
    names = sorted(frame.columns)
    result = connection.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} against {sorted(result.columns)}"
    ordered = ", ".join(f'"{name}"' for name in names)
    expected = connection.sql(f"SELECT {ordered} FROM ({sql})").fetchall()
    found = [tuple(row) for row in frame.select(*names).collect()]
    return same_rows(found, expected)
