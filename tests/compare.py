"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "double": "double",
    "float": "float", "string": "string", "varchar": "string", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    "boolean": "boolean", "date": "date",
}


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{path}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _key(row):
    return tuple((c is None, str(type(c)), f"{c:.6g}" if isinstance(c, float) else str(c)) for c in row)


def differences(df, con, sql: str) -> list[str]:
    """Messages on names, types, row count and values; empty when equal."""
    result = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(result.columns):
        return [f"columns {names} != {sorted(result.columns)}"]
    problems = []
    spark_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    duck_types = {n: KINDS.get(str(t).lower(), str(t).lower()) for n, t in zip(result.columns, result.types)}
    for n in names:
        if spark_types[n] != duck_types[n]:
            problems.append(f"type of {n}: {spark_types[n]} != {duck_types[n]}")
    left = sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=_key)
    index = [result.columns.index(n) for n in names]
    right = sorted((tuple(_cell(r[i]) for i in index) for r in result.fetchall()), key=_key)
    if len(left) != len(right):
        return problems + [f"rows {len(left)} != {len(right)}"]
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        problems.append(f"{len(bad)} of {len(left)} rows differ over {names}, first {bad[0]}")
    if not left:
        problems.append("no rows")
    return problems
