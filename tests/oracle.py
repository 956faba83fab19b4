"""Compare a query's rows with DuckDB's, independent of row order."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else a short account of how they differ."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    if expected == actual:
        return None
    extra, lacking = sorted(set(actual) - set(expected)), sorted(set(expected) - set(actual))
    return f"{len(actual)} vs {len(expected)} rows; only here {extra[:3]}; only there {lacking[:3]}"
