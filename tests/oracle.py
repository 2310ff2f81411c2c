"""Compares a query with its SQL in DuckDB: rows, columns by name, values in any order."""

import datetime
import decimal
import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")


def plain(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differs(spark, query, sql, data=DATA):
    """None if both agree, else what differs."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    got = con.execute(sql)
    want = table_of([d[0] for d in got.description], got.fetchall())
    df = query(spark, data)
    have = table_of(df.columns, [tuple(r) for r in df.collect()])
    if want[0] != have[0]:
        return f"columns {have[0]}, SQL {want[0]}"
    if len(want[1]) != len(have[1]):
        return f"{len(have[1])} rows, SQL {len(want[1])}"
    return next((f"{a} instead of {b}" for a, b in zip(have[1], want[1], strict=True) if a != b), None)
