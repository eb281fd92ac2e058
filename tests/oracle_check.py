"""Run the catalogue beside its SQL counterparts and compare whole results."""

from __future__ import annotations

import datetime
import hashlib
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, datetime.datetime) and value.tzinfo is None:
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return hashlib.sha256(bytes(value)).hexdigest()
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """(ok, message, seconds)"""
    start = time.time()
    df = query(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL", seconds
    cursor = con.execute(sql)
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}", seconds
    if got[1] == want[1]:
        return True, f"{len(got[1])} rows", seconds
    only_got = sorted(set(got[1]) - set(want[1]))
    only_want = sorted(set(want[1]) - set(got[1]))
    return (
        False,
        f"{len(got[1])} vs {len(want[1])} rows; {got[0]}\n  spark {only_got[:2]}\n  sql   {only_want[:2]}"[:1500],
        seconds,
    )
