"""Series tables derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..panel import Panel


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_panel(spark: SparkSession, folder: str) -> Panel:
    """Daily order value per priority."""
    return Panel.aggregate(
        table(spark, folder, "orders"),
        {"priority": "o_orderpriority"},
        "o_orderdate",
        {"sales": F.sum("o_totalprice")},
    )


def merchant_panel(spark: SparkSession, folder: str) -> Panel:
    """Daily number and value of orders per priority."""
    return Panel.aggregate(
        table(spark, folder, "orders"),
        {"merchant": "o_orderpriority"},
        "o_orderdate",
        {"transactions": F.count("*"), "paid": F.sum("o_totalprice")},
    )


def sparse_panel(spark: SparkSession, folder: str) -> Panel:
    """Daily shipped quantity per supplier and return flag: many series with gaps."""
    return Panel.aggregate(
        table(spark, folder, "lineitem"),
        {"supplier": "l_suppkey", "flag": "l_returnflag"},
        "l_shipdate",
        {"sales": F.sum("l_quantity")},
    )


def monthly_sales(spark: SparkSession, folder: str) -> Panel:
    """Monthly order value per priority."""
    return Panel.aggregate(
        table(spark, folder, "orders"),
        {"priority": "o_orderpriority"},
        "o_orderdate",
        {"sales": F.sum("o_totalprice")},
        period="month",
    )


def monthly_shipments(spark: SparkSession, folder: str) -> Panel:
    """Monthly shipped quantity per supplier."""
    return Panel.aggregate(
        table(spark, folder, "lineitem"),
        {"supplier": "l_suppkey"},
        "l_shipdate",
        {"sales": F.sum("l_quantity")},
        period="month",
    )


def monthly_orders(spark: SparkSession, folder: str) -> Panel:
    """Monthly order value per customer (named like the suppliers' panel): series of very different lengths."""
    return Panel.aggregate(
        table(spark, folder, "orders"),
        {"supplier": "o_custkey"},
        "o_orderdate",
        {"sales": F.sum("o_totalprice")},
        period="month",
    )


def hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw event values: an irregular source for resampling."""
    return table(spark, folder, "events").select("event_type", "ts", "event_id", "value")


def daily_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Mean discount per ship day: a per-date covariate."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("ship_date"))
        .agg(
            F.avg("l_discount").alias("price"),
            F.min("l_discount").alias("low"),
            F.max("l_discount").alias("high"),
        )
    )
