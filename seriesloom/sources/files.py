"""CSV input with declared schemas, and forecast output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import parse_date


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    dates: Mapping[str, Sequence[str]] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Read CSV files with a header into typed columns.

    ``schema`` is a DDL string for all columns in file order, so nothing is
    inferred and the files are read once. ``dates`` maps string columns to the
    formats they may be written in; ``drop`` names columns that are not data,
    such as a written-out row number.
    """
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    if dates:
        df = df.withColumns({c: parse_date(F.col(c), *formats) for c, formats in dates.items()})
    return df.drop(*drop)


def write_forecast(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """Write a forecast as Parquet or as CSV with a header, one file per task."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
