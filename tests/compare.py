"""Compare Spark results with the DuckDB statements, by column names, types and rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE:
        con.execute(f"create view {table} as select * from '{os.path.join(sf_dir, table)}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value) if value is not None else None


DUCK_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date"}


def duck_type(kind) -> str:
    name = str(kind)
    return DUCK_TYPES.get(name, name.lower())


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty if nothing does."""
    cursor = con.execute(sql)
    kinds = {c[0]: duck_type(c[1]) for c in cursor.description}
    expected = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = []
    if set(kinds) != set(spark_kinds):
        return [f"columns: {sorted(set(spark_kinds) ^ set(kinds))}"]
    found += [f"type of {c}: spark {spark_kinds[c]}, expected {kinds[c]}" for c in kinds if kinds[c] != spark_kinds[c]]
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        found.append(f"rows: spark {len(actual)}, expected {len(expected)}")
    if actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
        if wrong:
            found.append(f"{len(wrong)} rows differ, first: spark {wrong[0][0]} expected {wrong[0][1]}")
    return found
