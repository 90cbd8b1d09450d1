"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, decimal.Decimal)) and not isinstance(value, float):
        return ("int", int(value))
    if isinstance(value, float):
        if math.isnan(value):
            return ("float", "nan")
        return ("float", round(value, 7) + 0.0)
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return table(columns, cursor.fetchall())


def difference(left, right, show: int = 3) -> str | None:
    """None when equal, else a short description."""
    (names_l, rows_l), (names_r, rows_r) = left, right
    if names_l != names_r:
        return f"columns {names_l} != {names_r}"
    if rows_l == rows_r:
        return None
    missing = [r for r in rows_l if r not in set(rows_r)][:show]
    extra = [r for r in rows_r if r not in set(rows_l)][:show]
    return f"{len(rows_l)} vs {len(rows_r)} rows\n  spark only {missing}\n  sql only {extra}\n  {names_l}"
