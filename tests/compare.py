"""Runs a registered query and its SQL twin on the same tables and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    columns, rows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    other = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(other):
        return f"columns {sorted(columns)} != {sorted(other)}"
    mine, theirs = rows_of(columns, rows), rows_of(other, expected)
    if mine == theirs:
        kinds = {c: t for c, t in spark_df.dtypes}
        odd = {c: t for c, t in kinds.items() if t not in ("bigint", "double", "string", "int")}
        return f"unusual types {odd}" if odd else None
    a, b = set(mine) - set(theirs), set(theirs) - set(mine)
    return f"rows {len(mine)} vs {len(theirs)}; only spark {sorted(a)[:3]}; only sql {sorted(b)[:3]}"
