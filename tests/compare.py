"""Run a query and its SQL on the same tables and compare every value."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(made, key=repr)


def difference(df, connection, sql):
    """None when equal, else a short account of the first difference."""
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"\n  spark {dict(zip(got_names, a))}\n  sql   {dict(zip(got_names, b))}"
    return None
