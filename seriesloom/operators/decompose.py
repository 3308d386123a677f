"""Classical decomposition into trend, season and residual."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..panel import Panel


def decompose(panel: Panel, period: int = 12, model: str = "additive") -> DataFrame:
    """Trend, seasonal and residual part of every row of a gap-free panel.

    The trend is the centred moving average over one period (for an even period
    the two end rows count half) and NULL where the window leaves the series. The
    season is the mean of the detrended values at the same position in the
    period, moved so that the period sums to zero (or averages to one). All three
    steps run on one partitioning by series, with no further shuffle.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown model {model!r}")
    additive = model == "additive"
    panel = panel.spread_null_keys()
    w = panel.window()
    half = period // 2
    y = F.col(panel.y).cast("double")
    whole = F.count(y).over(w.rowsBetween(-half, half)) == 2 * half + 1
    if period % 2:
        trend = F.avg(y).over(w.rowsBetween(-half, half))
    else:
        trend = (
            F.sum(y).over(w.rowsBetween(-half, half - 1)) + F.sum(y).over(w.rowsBetween(-half + 1, half))
        ) / F.lit(2.0 * period)
    df = panel.df.withColumns(
        {
            "trend": panel.of_series(F.when(whole, trend)),
            "_phase": (F.row_number().over(w) - 1) % period,
        }
    )
    detrended = y - F.col("trend") if additive else y / F.col("trend")
    df = df.withColumn("_detrended", detrended)

    by_phase = Window.partitionBy(*panel.partition_columns(), "_phase")
    df = df.withColumns(
        {
            "_phase_mean": F.avg("_detrended").over(by_phase),
            "_phase_rows": F.count(F.lit(1)).over(by_phase),
        }
    )
    # Each phase counts once in the mean of the phases, however many rows it has.
    by_series = panel.group_window()
    share = F.col("_phase_mean") / F.col("_phase_rows")
    phases = F.sum(F.when(F.col("_phase_mean").isNotNull(), 1.0 / F.col("_phase_rows"))).over(by_series)
    centre = F.sum(share).over(by_series) / phases
    seasonal = F.col("_phase_mean") - centre if additive else F.col("_phase_mean") / centre
    df = df.withColumn("seasonal", panel.of_series(seasonal))
    residual = (
        y - F.col("trend") - F.col("seasonal")
        if additive
        else y / (F.col("trend") * F.col("seasonal"))
    )
    df = df.withColumn("residual", residual)
    return panel.with_df(
        df.drop("_phase", "_detrended", "_phase_mean", "_phase_rows")
    ).frame()


def components_long(parts: DataFrame, keys: list[str], ts: str, y: str) -> DataFrame:
    """One row per (keys, time, component): the data behind a four-panel figure."""
    return parts.select(*keys, ts, F.col(y).cast("double").alias("observed"), "trend", "seasonal", "residual").unpivot(
        [*keys, ts], ["observed", "trend", "seasonal", "residual"], "component", "value"
    )


def component_means(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Mean seasonal and residual part per series."""
    return parts.groupBy(*keys).agg(
        F.avg("seasonal").alias("seasonal_mean"), F.avg("residual").alias("residual_mean")
    )
