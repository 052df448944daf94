"""Runs a registered query and its SQL side by side and compares the rows, whatever their order."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb

import __spark_entry__ as entry_module


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, folder: str) -> tuple[list, list, list, list]:
    df = entry_module.queries()[name](spark, folder)
    rel = con.execute(entry_module.oracle_sql()[name])
    oracle_columns = [d[0] for d in rel.description]
    return (
        sorted(df.columns), sorted(oracle_columns),
        rows_of(df.columns, df.collect()), rows_of(oracle_columns, rel.fetchall()),
    )
