"""Compare a Spark result with its oracle: column names, row count, and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(out, key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return float(a) == float(b)
    return a == b


def compare(spark_df, con, sql: str) -> tuple[list[str], int]:
    """Problems found (empty when equal) and the number of rows."""
    left_cols, left = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    right_cols, right = rows(names, cursor.fetchall())
    problems = []
    if left_cols != right_cols:
        problems.append(f"columns {left_cols} != {right_cols}")
        return problems, len(left)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    for l, r in zip(left, right):
        if not all(same(a, b) for a, b in zip(l, r)):
            problems.append(f"first difference\n  spark  {l}\n  oracle {r}\n  in {left_cols}")
            break
    return problems, len(left)
