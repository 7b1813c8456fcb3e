"""Side-by-side runs of registered queries and their SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def sql_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=lambda row: [(c is None, str(type(c)), c if c is not None else 0) for c in row])


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return _rows([c[0] for c in cursor.description], cursor.fetchall())


def first_difference(ours, theirs) -> str | None:
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a} against {b}"
    return None
