"""The table of runnable queries, each with the SQL that says what it means."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 4
#: Further digits of the first of two roundings.
GUARD = 4
#: From here on doubles are whole numbers.
WHOLE = 9e15
#: Expressions of more rounded columns make one generated method too long (8,000 bytes) for the JVM to compile.
WIDE = 12


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder); ``sql`` is the same thing in ANSI SQL."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(c: Column, digits: int = DIGITS) -> Column:
    """Round a double, which stays one: NaN, infinities and values without a fraction are kept.

    Means of a few decimals often end in an exact half, where the last bit of a sum
    decides. Where a double has the digits, rounding to a few more of them first
    clears that bit in both engines.
    """
    fine, coarse = 10.0 ** (digits + GUARD), 10.0**digits
    once = F.round(F.round(c * F.lit(fine)) / F.lit(fine) * F.lit(coarse)) / F.lit(coarse)
    size = F.abs(c)
    near = F.when(size < WHOLE / fine, once).when(size < WHOLE / coarse, F.round(c * F.lit(coarse)) / F.lit(coarse))
    return near.otherwise(c) + F.lit(0.0)


def rounded_in_batches(digits: int = DIGITS) -> Callable[[Column], Column]:
    """:func:`rounded` bit by bit, as a function of Arrow batches: any number of columns share one pass."""
    fine, coarse = 10.0 ** (digits + GUARD), 10.0**digits

    def whole(size: np.ndarray) -> np.ndarray:
        # Halves go up: twice the size loses nothing, nor does half of a whole number.
        return np.ceil(np.floor(size * 2.0) / 2.0)

    def batch(c: pa.Array) -> pa.Array:
        values, missing = c.to_numpy(zero_copy_only=False).astype(np.float64), c.is_null().to_numpy(zero_copy_only=False)
        size = np.abs(values)
        with np.errstate(over="ignore", invalid="ignore"):
            once = whole(whole(size * fine) / fine * coarse) / coarse
            near = np.where(size < WHOLE / fine, once, np.where(size < WHOLE / coarse, whole(size * coarse) / coarse, size))
        return pa.array(np.copysign(near, values) + 0.0, pa.float64(), mask=missing)

    batch.__annotations__ = {"c": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "double")


def shown(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rounded numbers and dates as text, so that two engines can be compared by value."""
    columns, doubles = [], (T.DoubleType, T.FloatType)
    in_batches = rounded_in_batches(digits) if sum(isinstance(f.dataType, doubles) for f in df.schema.fields) > WIDE else None
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, doubles):
            c = in_batches(c.cast("double")) if in_batches else rounded(c, digits)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def num(expr: str, name: str | None = None, digits: int = DIGITS) -> str:
    """SQL counterpart of the rounding in :func:`shown`."""
    x, fine, coarse = f"CAST({expr} AS DOUBLE)", f"1e{digits + GUARD}", f"1e{digits}"
    return (
        f"CASE WHEN abs({x}) < {WHOLE} / {fine} THEN round(round({x} * {fine}) / {fine} * {coarse}) / {coarse}"
        f" WHEN abs({x}) < {WHOLE} / {coarse} THEN round({x} * {coarse}) / {coarse} ELSE {x} END + CAST(0 AS DOUBLE) AS {name or expr}"
    )


def day(expr: str = "ts", name: str | None = None) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name or expr}"


# Shared SQL definitions of the series tables in sources/tables.py.
SALES = """sales_panel AS (
  SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS ts, sum(o_totalprice) AS sales
  FROM orders GROUP BY 1, 2)"""
MERCHANT = """merchant_panel AS (
  SELECT o_orderpriority AS merchant, CAST(o_orderdate AS DATE) AS ts,
         count(*) AS transactions, sum(o_totalprice) AS paid
  FROM orders GROUP BY 1, 2)"""
SPARSE = """sparse_panel AS (
  SELECT l_suppkey AS supplier, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ts,
         sum(l_quantity) AS sales
  FROM lineitem GROUP BY 1, 2, 3)"""
DENSE = (
    SALES
    + """, dense_days AS (
  SELECT priority, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS DATE) AS ts
  FROM sales_panel GROUP BY priority),
dense AS (
  SELECT d.priority, d.ts, s.sales,
         row_number() OVER (PARTITION BY d.priority ORDER BY d.ts) AS rn
  FROM dense_days d LEFT JOIN sales_panel s ON s.priority = d.priority AND s.ts = d.ts)"""
)
MONTHLY = """month_rows AS (
  SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS ts,
         sum(l_quantity) AS sales
  FROM lineitem GROUP BY 1, 2),
month_spine AS (
  SELECT supplier, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS DATE) AS ts
  FROM month_rows GROUP BY supplier),
month_gaps AS (
  SELECT p.supplier, p.ts, m.sales
  FROM month_spine p LEFT JOIN month_rows m ON m.supplier = p.supplier AND m.ts = p.ts),
monthly AS (
  SELECT supplier, ts,
         coalesce(sales, first_value(sales IGNORE NULLS) OVER (
           PARTITION BY supplier ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS y,
         row_number() OVER (PARTITION BY supplier ORDER BY ts) AS rn,
         count(*) OVER (PARTITION BY supplier) AS n
  FROM month_gaps)"""
