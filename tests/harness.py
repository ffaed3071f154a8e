"""Runs a query on both engines and compares the rows regardless of their order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if hasattr(value, "as_tuple"):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(folder: str, sql: str):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _rows(names, result.fetchall())
