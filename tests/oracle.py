"""Compares a query with its SQL on DuckDB: columns by name, rows in any order, floats to twelve digits."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows(columns: list[str], values: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


def difference(spark, sf_dir: str, query, sql: str) -> str:
    """What differs, empty if nothing."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    found = connect(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    want = rows(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}; first of each {got[:2]} {want[:2]}"
    wrong = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""
