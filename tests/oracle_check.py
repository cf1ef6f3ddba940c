"""Compares registered queries with their SQL on the same Parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[place] for place in order]) for row in rows)


def differences(df, sql: str, connection) -> str | None:
    """None when both results hold the same rows, else what differs."""
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(set(df.columns) ^ set(relation.columns))}"
    ours = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    theirs = _sorted_rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    missing, extra = sorted(set(theirs) - set(ours)), sorted(set(ours) - set(theirs))
    return f"{len(ours)} rows for {len(theirs)}; missing {missing[:2]}; extra {extra[:2]}"
