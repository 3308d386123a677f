"""Forecasting one or many regular series: fill, hold out, test, search, refit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import orders as order_search
from ..operators import smoothing, stationarity, windows
from ..operators.decompose import decompose
from ..operators.grid import Grid
from ..panel import Panel


@dataclass(frozen=True)
class Study:
    """All tables of a study; nothing is computed before one of them is used."""

    filled: Panel
    stationarity: DataFrame
    components: DataFrame
    methods: DataFrame
    orders: DataFrame
    forecast: DataFrame


def study(
    panel: Panel,
    horizon: int,
    ahead: int,
    grids: Mapping[str, Grid],
    orders: Sequence[order_search.Order] | None = None,
    init: str = "simple",
    period: int = 12,
    every: str = "month",
) -> Study:
    """Complete the calendar, fill gaps, and search smoothing weights and orders on a holdout.

    The forecast comes from the last of ``grids``, refitted on all values.
    """
    filled = windows.backward_fill(windows.calendar_spine(panel, every))
    keys = [*panel.keys]
    split = smoothing.split_last(smoothing.series_arrays(filled), horizon)
    method, grid = list(grids.items())[-1]
    return Study(
        filled=filled,
        stationarity=stationarity.adf_test(split, keys),
        components=decompose(filled, period),
        methods=smoothing.compare_methods(split, keys, grids, init, period),
        orders=order_search.order_scores(filled, orders or order_search.sarima_orders(2), horizon, period),
        forecast=smoothing.search_and_forecast(split, keys, method, grid, ahead, init, period),
    )
