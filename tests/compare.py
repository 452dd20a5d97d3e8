"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(row[i]) for i in order) for row in data]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows(names, result.fetchall())
