"""Exponential smoothing of every series, as array folds inside the JVM.

A series is collected to one array. That is safe because a panel holds one row
per (keys, date): an array is never longer than the calendar. All folds and the
whole parameter search then run on that one row, with no further shuffle. Single
fits stay in the JVM; searches use :mod:`smoothing_lanes`.

Recurrences (l level, b trend, s season of ``period`` slots, y value):

* single:  l = a*y + (1-a)*l
* double:  l = a*y + (1-a)*(l+b);  b = B*(l-l') + (1-B)*b
* triple, additive:  l = a*(y-s) + (1-a)*(l+b);  b as above;
  s = g*(y-l'-b') + (1-g)*s
* triple, multiplicative:  l = a*(y/s) + (1-a)*(l*b);  b = B*(l/l') + (1-B)*b;
  s = g*(y/(l'*b')) + (1-g)*s

(Holt 1957; Winters 1960.)

The start of a series is either ``simple`` (first values; for the triple form
the first two seasons) or ``ls``: the start with the least squared one-step
errors. For fixed weights those errors are linear in the start, so ``ls`` is a
small linear solve, summed up in the same fold.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..panel import Panel
from .grid import Grid, pick_best, tie
from .smoothing_lanes import BLOCK_CELLS, BLOCK_LANES, forecasts, holdout_errors

METHODS = ("single", "double", "triple", "triple_mul")


def series_arrays(panel: Panel) -> DataFrame:
    """One row per series: keys, first date and the values in time order."""
    if not panel.calendar_bound:
        raise TypeError("series arrays need a DATE time column: its calendar bounds their length")
    df = panel.df.where(panel.has_key) if panel.null_keys else panel.df
    # Fits are heavy for their few bytes, so the number of tasks must not follow the
    # bytes: a counted repartition is left alone by adaptive coalescing.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(tasks, *panel.keys)
    rows = F.sort_array(F.collect_list(F.struct(F.col(panel.ts), F.col(panel.y).cast("double").alias("y"))))
    return (
        df.groupBy(*panel.keys)
        .agg(rows.alias("_rows"))
        .select(
            *panel.keys,
            F.col("_rows")[0][panel.ts].alias("first_ts"),
            F.transform("_rows", lambda r: r["y"]).alias("y"),
        )
    )


def split_last(arrays: DataFrame, horizon: int) -> DataFrame:
    """Add ``train`` and ``test`` arrays: the last ``horizon`` values are held out.

    A series that has nothing left to train on stays, with NULL for both.
    """
    n, long = F.size("y"), F.size("y") > horizon
    return arrays.withColumns(
        {
            "train": F.when(long, F.slice("y", F.lit(1), F.greatest(n - horizon, F.lit(0)))),
            "test": F.when(long, F.slice("y", F.greatest(n - horizon, F.lit(0)) + 1, F.lit(horizon))),
        }
    )


def _tail(y: Column) -> Column:
    return F.slice(y, F.lit(2), F.greatest(F.size(y) - 1, F.lit(0)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for n, c in fields.items()])




def _single(y: Column, p: Mapping[str, Column], init: str) -> Column:
    a = p["alpha"]
    if init == "simple":
        level = F.aggregate(_tail(y), F.get(y, F.lit(0)), lambda l, v: a * v + (1 - a) * l)
        return _struct(level=level, trend=F.lit(0.0), level_0=F.get(y, F.lit(0)), trend_0=F.lit(0.0))
    # Level = c + g * start, with c for a start of zero and g the decay so far.
    start = _struct(c=F.lit(0.0), g=F.lit(1.0), gr=F.lit(0.0), gg=F.lit(0.0))

    def step(s: Column, v: Column) -> Column:
        return _struct(
            c=a * v + (1 - a) * s["c"],
            g=(1 - a) * s["g"],
            gr=s["gr"] + s["g"] * (v - s["c"]),
            gg=s["gg"] + s["g"] * s["g"],
        )

    def finish(s: Column) -> Column:
        level_0 = _ratio(s["gr"], s["gg"])
        return _struct(
            level=s["c"] + s["g"] * level_0, trend=F.lit(0.0), level_0=level_0, trend_0=F.lit(0.0)
        )

    return F.aggregate(y, start, step, finish)


def _double(y: Column, p: Mapping[str, Column], init: str) -> Column:
    a, b = p["alpha"], p["beta"]

    def advance(level: Column, trend: Column, v: Column) -> tuple[Column, Column]:
        new = a * v + (1 - a) * (level + trend)
        return new, b * (new - level) + (1 - b) * trend

    if init == "simple":
        first, second = F.get(y, F.lit(0)), F.get(y, F.lit(1))
        rise = second - first

        def step(s: Column, v: Column) -> Column:
            level, trend = advance(s["level"], s["trend"], v)
            return _struct(level=level, trend=trend)

        return F.aggregate(
            _tail(y),
            _struct(level=first, trend=rise),
            step,
            lambda s: _struct(level=s["level"], trend=s["trend"], level_0=first, trend_0=rise),
        )

    # (l, t) runs from a zero start; (l1, t1) and (l2, t2) answer to a unit level
    # and a unit trend. x and z are the two regressors of the one-step error r.
    names = ("l", "t", "l1", "t1", "l2", "t2", "xx", "xz", "zz", "xr", "zr")
    start = _struct(**{n: F.lit(1.0 if n in ("l1", "t2") else 0.0) for n in names})

    def step(s: Column, v: Column) -> Column:
        x, z = s["l1"] + s["t1"], s["l2"] + s["t2"]
        r = v - s["l"] - s["t"]
        l, t = advance(s["l"], s["t"], v)
        l1, t1 = advance(s["l1"], s["t1"], F.lit(0.0))
        l2, t2 = advance(s["l2"], s["t2"], F.lit(0.0))
        return _struct(
            l=l, t=t, l1=l1, t1=t1, l2=l2, t2=t2,
            xx=s["xx"] + x * x, xz=s["xz"] + x * z, zz=s["zz"] + z * z,
            xr=s["xr"] + x * r, zr=s["zr"] + z * r,
        )

    def solve(s: Column) -> Column:
        det = s["xx"] * s["zz"] - s["xz"] * s["xz"]
        level_0 = _ratio(s["xr"] * s["zz"] - s["zr"] * s["xz"], det)
        trend_0 = _ratio(s["zr"] * s["xx"] - s["xr"] * s["xz"], det)
        return _struct(
            level=s["l"] + s["l1"] * level_0 + s["l2"] * trend_0,
            trend=s["t"] + s["t1"] * level_0 + s["t2"] * trend_0,
            level_0=level_0,
            trend_0=trend_0,
        )

    return F.aggregate(y, start, step, solve)


def _mean(values: Column, n: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / n


def _triple(y: Column, p: Mapping[str, Column], period: int, multiplicative: bool) -> Column:
    a, b, g = p["alpha"], p["beta"], p["gamma"]
    first = F.slice(y, F.lit(1), F.lit(period))
    level_0 = _mean(first, period)
    second = _mean(F.slice(y, F.lit(period + 1), F.lit(period)), period)
    if multiplicative:
        trend_0 = F.pow(_ratio(second, level_0), F.lit(1.0 / period))
        season_0 = F.transform(first, lambda v: v / level_0)
    else:
        trend_0 = (second - level_0) / period
        season_0 = F.transform(first, lambda v: v - level_0)

    def state(level: Column, trend: Column, season: Column) -> Column:
        return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"))

    def step(s: Column, v: Column) -> Column:
        level, trend, season = s["level"], s["trend"], s["season"]
        slot = F.get(season, F.lit(0))
        if multiplicative:
            base = level * trend
            new = a * _ratio(v, slot) + (1 - a) * base
            slope = b * _ratio(new, level) + (1 - b) * trend
            fresh = g * _ratio(v, base) + (1 - g) * slot
        else:
            base = level + trend
            new = a * (v - slot) + (1 - a) * base
            slope = b * (new - level) + (1 - b) * trend
            fresh = g * (v - base) + (1 - g) * slot
        # The oldest slot is used up and its successor goes to the end.
        turned = F.concat(F.slice(season, F.lit(2), F.lit(period - 1)), F.array(fresh))
        return state(new, slope, turned)

    def finish(s: Column) -> Column:
        return F.struct(
            s["level"].alias("level"),
            s["trend"].alias("trend"),
            s["season"].alias("season"),
            level_0.alias("level_0"),
            trend_0.alias("trend_0"),
            season_0.alias("season_0"),
        )

    folded = F.aggregate(y, state(level_0, trend_0, season_0), step, finish)
    return F.when(F.size(y) >= 2 * period, folded)


def fitted_state(
    method: str, y: Column, params: Mapping[str, Column], init: str = "simple", period: int = 12
) -> Column:
    """Struct with the start and the final state of one method on an array of values."""
    if init not in ("simple", "ls"):
        raise ValueError(f"unknown init {init!r}")
    if method == "single":
        return _single(y, params, init)
    if method == "double":
        return _double(y, params, init)
    if method in ("triple", "triple_mul"):
        if init != "simple":
            raise ValueError("the triple form starts from its first two seasons only")
        return _triple(y, params, period, method == "triple_mul")
    raise ValueError(f"unknown method {method!r}")


def _ahead(method: str, state: Column, k: Column, period: int) -> Column:
    """Forecast ``k`` steps after the last value, from a fitted state."""
    if method == "single":
        return state["level"]
    if method == "double":
        return state["level"] + k * state["trend"]
    slot = F.get(state["season"], F.pmod(k - 1, F.lit(period)).cast("int"))
    if method == "triple":
        return state["level"] + k * state["trend"] + slot
    return state["level"] * F.pow(state["trend"], k) * slot


def grid_errors(
    train: Column, test: Column, method: str, grid: Grid, init: str = "simple", period: int = 12
) -> Column:
    """Array of holdout errors in grid order; NULL where a grid point gives no number or nothing is held out."""
    if method not in METHODS or init not in ("simple", "ls"):
        raise ValueError(f"unknown method {method!r} or init {init!r}")
    if init == "ls" and method == "triple_mul":
        raise ValueError("the multiplicative form is not linear in its start: use init='simple'")
    params = grid.arrays()

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def errors(trains: pd.Series, tests: pd.Series) -> pd.Series:
        out = [[None] * grid.size] * len(trains)
        lengths = np.array([-1 if t is None else len(t) for t in trains])
        for n in np.unique(lengths[lengths >= 0]):
            (rows,) = np.nonzero(lengths == n)
            block = max(1, min(BLOCK_LANES, BLOCK_CELLS // max(1, n)) // grid.size)
            for some in np.array_split(rows, -(-len(rows) // block)):
                scored = holdout_errors(
                    method, np.stack(trains.iloc[some]), np.stack(tests.iloc[some]), params, init, period
                )
                for i, r in zip(some, scored):
                    out[i] = [float(v) if np.isfinite(v) else None for v in r]
        return pd.Series(out)

    return errors(train, test)


def _scored(errors: Column, grid: Grid) -> Column:
    """Array of structs (mae, grid_id, parameters)."""
    return F.zip_with(
        grid.column(),
        errors,
        lambda point, mae: F.struct(
            mae.alias("mae"), point["grid_id"].alias("grid_id"), *[point[n].alias(n) for n in grid.axes]
        ),
    )


def grid_scores(
    split: DataFrame,
    keys: list[str],
    method: str,
    grid: Grid,
    init: str = "simple",
    period: int = 12,
) -> DataFrame:
    """Holdout error of every (series, grid point).

    ``split`` comes from :func:`split_last`. The grid is worked through on the row
    of the series; only the scores are exploded.
    """
    errors = split.select(
        *keys, grid_errors(F.col("train"), F.col("test"), method, grid, init, period).alias("_errors")
    )
    return errors.select(*keys, F.explode(_scored(F.col("_errors"), grid)).alias("_s")).select(
        *keys, "_s.grid_id", *[f"_s.{n}" for n in grid.axes], "_s.mae"
    )


def grid_best(
    split: DataFrame,
    keys: list[str],
    method: str,
    grid: Grid,
    init: str = "simple",
    period: int = 12,
) -> DataFrame:
    """The best grid point of every series by holdout error."""
    return pick_best(grid_scores(split, keys, method, grid, init, period), keys, "mae", [*grid.axes])


def compare_methods(
    split: DataFrame, keys: list[str], grids: Mapping[str, Grid], init: str = "simple", period: int = 12
) -> DataFrame:
    """Rows (keys, method, mae): the best holdout error each method reaches.

    The grids are worked through on the one row of a series, method after method.
    """
    found = [
        F.struct(
            F.lit(method).alias("method"),
            F.array_min(grid_errors(F.col("train"), F.col("test"), method, grid, init, period)).alias("mae"),
        )
        for method, grid in grids.items()
    ]
    return split.select(*keys, F.inline(F.array(*found)))


def forecast(
    arrays: DataFrame,
    keys: list[str],
    method: str,
    horizon: int,
    params: Mapping[str, float | Column],
    init: str = "simple",
    period: int = 12,
    column: str = "y",
    step: str = "1 month",
) -> DataFrame:
    """Dated forecasts of the ``horizon`` periods after each series.

    ``params`` are numbers, or columns of ``arrays`` where each series has its own.
    """
    bound = {n: v if isinstance(v, Column) else F.lit(float(v)) for n, v in params.items()}
    fitted = arrays.withColumn("_state", fitted_state(method, F.col(column), bound, init, period))
    ahead = fitted.select(
        *keys, "first_ts", F.size(column).alias("_n"), "_state", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    )
    unit = step.split()[1]
    moved = F.col("_n") + F.col("step") - 1
    date = F.add_months("first_ts", moved) if unit.startswith("month") else F.date_add("first_ts", moved)
    return ahead.select(
        *keys,
        "step",
        date.alias("ts"),
        _ahead(method, F.col("_state"), F.col("step"), period).alias("prediction"),
    )


def parameter_rows(
    arrays: DataFrame,
    keys: list[str],
    method: str,
    params: Mapping[str, float],
    init: str = "simple",
    period: int = 12,
) -> DataFrame:
    """The weights and the start of a fit, one row per (series, parameter)."""
    bound = {n: F.lit(float(v)) for n, v in params.items()}
    state = fitted_state(method, F.col("y"), bound, init, period)
    fitted = arrays.select(*keys, state.alias("_state"))
    named = [F.struct(F.lit(n).alias("parameter"), c.alias("value")) for n, c in bound.items()]
    named.append(F.struct(F.lit("initial_level").alias("parameter"), F.col("_state.level_0").alias("value")))
    if method != "single":
        named.append(F.struct(F.lit("initial_trend").alias("parameter"), F.col("_state.trend_0").alias("value")))
    rows = F.array(*named)
    if method in ("triple", "triple_mul"):
        seasons = F.transform(
            F.col("_state.season_0"),
            lambda v, i: F.struct(
                F.concat(F.lit("initial_season_"), i.cast("string")).alias("parameter"), v.alias("value")
            ),
        )
        rows = F.concat(rows, seasons)
    return fitted.select(*keys, F.explode(rows).alias("_p")).select(*keys, "_p.*")


def search_and_forecast(
    split: DataFrame,
    keys: list[str],
    method: str,
    grid: Grid,
    horizon: int,
    init: str = "simple",
    period: int = 12,
    default: float = 0.5,
) -> DataFrame:
    """Choose weights on the holdout, refit on the whole series, forecast on.

    Everything happens on the row of the series: the best grid point is the least
    (error, grid number) of its own scores, so nothing is joined or shuffled. A
    series without a usable error gets the ``default`` weights; its forecasts are
    NULL only where the method needs more values than it has.
    """
    errors = grid_errors(F.col("train"), F.col("test"), method, grid, init, period)
    tried = split.withColumn("_errors", errors)
    usable = F.filter(_scored(F.col("_errors"), grid), lambda s: s["mae"].isNotNull())
    ranked = F.transform(
        usable, lambda s: F.struct(tie(s["mae"]), s["grid_id"], s.alias("point"))
    )
    best = tried.withColumn("_best", F.array_min(ranked))
    params = {n: F.coalesce(F.col("_best.point")[n], F.lit(default)) for n in grid.axes}
    if init == "ls" and method == "triple":
        return _forecast_from_least_squares(best, keys, horizon, params, period)
    return forecast(best, keys, method, horizon, params, init, period)


def _forecast_from_least_squares(
    arrays: DataFrame, keys: list[str], horizon: int, params: Mapping[str, Column], period: int, step: str = "1 month"
) -> DataFrame:
    """Forecasts of the additive triple form from the start with the least squared errors."""
    names = [*params]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def ahead(ys: pd.Series, points: pd.DataFrame) -> pd.Series:
        found = [forecasts("triple", np.asarray(y), dict(zip(names, p)), horizon, period) for y, p in zip(ys, points[names].to_numpy())]
        return pd.Series([None if f is None else [float(v) for v in f] for f in found], dtype=object)

    weights = F.struct(*[c.alias(n) for n, c in params.items()])
    rows = arrays.select(*keys, "first_ts", F.size("y").alias("_n"), ahead(F.col("y"), weights).alias("_f"))
    rows = rows.select(*keys, "first_ts", "_n", "_f", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    moved = F.col("_n") + F.col("step") - 1
    date = F.add_months("first_ts", moved) if step.split()[1].startswith("month") else F.date_add("first_ts", moved)
    return rows.select(*keys, "step", date.alias("ts"), F.get("_f", F.col("step") - 1).alias("prediction"))
