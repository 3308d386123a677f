"""Joins, unions, splits, encoding and forecast alignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_parts
from ..panel import Panel
from .skew import salted_join


def stack(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column a table lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def join_covariate(df: DataFrame, per_date: DataFrame, on: str, drop: Sequence[str] = ()) -> DataFrame:
    """Full outer join with a table by date; unmatched rows of both sides stay.

    There are few dates and many rows for each, so a plain join on the date would
    leave a handful of huge tasks. The rows of a date are spread by salt instead
    (or not shuffled at all, where Spark finds the other side small enough to
    broadcast), and dates only the other side has are added from a check against
    the distinct dates.
    """
    matched = salted_join(df, per_date, [on], F.xxhash64(*df.columns), how="left")
    lacking = per_date.join(df.select(on).distinct(), on=on, how="left_anti")
    return matched.unionByName(lacking, allowMissingColumns=True).drop(*drop)


def all_but(df: DataFrame, *drop: str) -> list[str]:
    """Column names except some: the usual way to write a feature list."""
    return [c for c in df.columns if c not in drop]


def cast_if_present(df: DataFrame, column: str, to: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast(to)) if column in df.columns else df


def add_calendar(df: DataFrame, ts: str, first_weekend_day: int = 4) -> DataFrame:
    """Append the calendar features of a date column."""
    return df.withColumns(calendar_parts(F.col(ts), first_weekend_day))


def between(df: DataFrame, ts: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with start <= ts < end; a bound left out is open."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end).cast("date"))
    return df


def through(df: DataFrame, ts: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows with first <= ts <= last: a label slice, which takes in both ends."""
    if first is not None:
        df = df.where(F.col(ts) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col(ts) <= F.lit(last).cast("date"))
    return df


def tag_split(df: DataFrame, ts: str, valid_from: str, valid_until: str) -> DataFrame:
    """Mark rows as train (before the validation range) or valid (in it); later rows go."""
    part = F.when(F.col(ts) < F.lit(valid_from).cast("date"), F.lit("train")).otherwise(F.lit("valid"))
    return between(df, ts, end=valid_until).withColumn("part", part)


def split_by_target(df: DataFrame, y: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a known target, and rows to be predicted."""
    return df.where(F.col(y).isNotNull()), df.where(F.col(y).isNull())


def split_by_position(panel: Panel, n_train: int) -> DataFrame:
    """Mark the first ``n_train`` rows of each series as train, the rest as test."""
    panel = panel.spread_null_keys()
    place = F.row_number().over(panel.window())
    part = F.when(place <= n_train, F.lit("train")).otherwise(F.lit("test"))
    return panel.with_df(panel.df.withColumn("part", panel.of_series(part))).frame()


def align(forecast: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Forecast and actual value side by side, matched on keys and time."""
    return actual.join(forecast, on=list(on), how="inner")


def unmatched(forecast: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Actual rows no forecast was made for; empty if the horizon is covered."""
    return actual.join(forecast.select(*on), on=list(on), how="left_anti")


def overlay(train: DataFrame, test: DataFrame, forecast: DataFrame) -> DataFrame:
    """Training values, test values and predictions in one labelled table."""
    parts = (("TRAIN", train), ("TEST", test), ("PREDICTION", forecast))
    return reduce(
        DataFrame.unionByName, [df.withColumn("part", F.lit(label)) for label, df in parts]
    )


def overlay_marked(df: DataFrame, keep: Sequence[str], y: str, prediction: str) -> DataFrame:
    """The same from one table with a train/test mark: each row is read once.

    Test rows give two rows, the measured and the predicted value.
    """
    measured = F.struct(F.col(y).alias(y), F.upper("part").alias("part"))
    predicted = F.struct(F.col(prediction).alias(y), F.lit("PREDICTION").alias("part"))
    rows = F.when(F.col("part") == "test", F.array(measured, predicted)).otherwise(F.array(measured))
    return df.select(*keep, F.inline(rows))


def category_values(df: DataFrame, columns: Sequence[str], limit: int = 10_000) -> dict[str, list]:
    """Sorted distinct known values per column, learned in one job.

    Every value becomes a column, so more than ``limit`` of them is an error
    rather than a table nobody can use.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    found = (
        df.select(F.explode(pairs).alias("_p"))
        .select("_p.*")
        .where(F.col("v").isNotNull())
        .distinct()
        .limit(limit + 1)
        .collect()
    )
    if len(found) > limit:
        raise ValueError(f"more than {limit} category values in {list(columns)}")
    types = dict(df.dtypes)
    values = {}
    for i, c in enumerate(columns):
        mine = [r["v"] for r in found if r["i"] == i]
        if types[c] in ("int", "bigint", "smallint", "tinyint"):
            values[c] = sorted(int(v) for v in mine)
        else:
            values[c] = sorted(mine)
    return values


def one_hot(
    df: DataFrame, columns: Sequence[str], values: dict[str, list] | None = None, keep: bool = False, limit: int = 10_000
) -> DataFrame:
    """Replace each column by 0/1 indicators named column_value, in value order; ``keep`` leaves it as well.

    Pass ``values`` learned on a training table to give another table the same
    columns. A missing value sets no indicator.
    """
    values = values or category_values(df, columns, limit)
    types = dict(df.dtypes)
    indicators: list[Column] = [
        F.coalesce((F.col(c) == F.lit(v).cast(types[c])).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in columns
        for v in values[c]
    ]
    return df.select(*[c for c in df.columns if keep or c not in columns], *indicators)


def submission(scored: DataFrame, id_column: str, prediction: Column, name: str) -> DataFrame:
    """64-bit id and prediction: the table handed in."""
    return scored.select(F.col(id_column).cast("bigint").alias(id_column), prediction.alias(name))


def previous_rows(panel: Panel, lags: Sequence[int]) -> DataFrame:
    """Value and its lags side by side, named lag1, lag2, ..."""
    panel = panel.spread_null_keys()
    w: Window = panel.window()
    lagged = {f"lag{k}": panel.of_series(F.lag(panel.y, k).over(w)) for k in lags}
    return panel.with_df(panel.df.withColumns(lagged)).frame()
