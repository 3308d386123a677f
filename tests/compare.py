"""Run a query in Spark and its SQL in DuckDB and compare all values."""

from __future__ import annotations

import datetime
import math
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def compare(spark, con, fn, sql: str, folder: str) -> tuple[str, float, float]:
    """Empty text if equal, else what differs; and both run times."""
    start = time.time()
    df = fn(spark, folder)
    rows = df.collect()
    middle = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    end = time.time()
    times = (middle - start, end - middle)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", *times
    spark_order = [df.columns.index(c) for c in sorted(names)]
    sql_order = [names.index(c) for c in sorted(names)]
    ours = Counter(tuple(plain(r[i]) for i in spark_order) for r in rows)
    theirs = Counter(tuple(plain(r[i]) for i in sql_order) for r in expected)
    if ours == theirs:
        return "", *times
    extra, lacking = list((ours - theirs).items()), list((theirs - ours).items())
    return (
        f"rows {len(rows)} vs {len(expected)}; {len(extra)} differ\n"
        f"    {sorted(names)}\n    ours   {sorted(extra)[:3]}\n    theirs {sorted(lacking)[:3]}",
        *times,
    )
