"""Results as sorted tuples of plain values, for Spark and DuckDB alike."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "tzinfo") and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def ordered(names, rows):
    """Column names and rows with columns by name and rows in order."""
    at = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in at], sorted((tuple(plain(r[i]) for i in at) for r in rows), key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def of_spark(df):
    return ordered(df.columns, [tuple(r) for r in df.collect()])


def of_sql(sql: str, sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    found = db.execute(sql)
    return ordered([d[0] for d in found.description], found.fetchall())
