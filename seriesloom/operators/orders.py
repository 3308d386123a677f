"""Orders of (seasonal) autoregressions with moving averages: search, coefficients and forecasts by sums of products.

An order (p, d, q, sp, sd, sq) differences a series d times by one step and sd times by a season. Moving averages are
fitted in two rounds of sums (Hannan and Rissanen): a long autoregression of ``LONG`` lags gives residuals, and
the differenced values are then regressed on their last p values, the last q residuals and, with sp and sq, on the value
and the residual a season before; a constant is fitted where nothing is differenced. All orders of one differencing share
their rows and sums: Spark adds the sums up per (series, differencing) before the shuffle, and an order is an
elimination of those columns it uses, done for a batch of series side by side. AIC is n*ln(sse/n) + 2(k+1) with n the rows used; orders of one differencing
are compared on the same rows.

Forecasts run the recursion over the last values and residuals of each series, later residuals being 0, and undo
the differences by the recursion of their polynomial. Rows without a key belong to no series.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..panel import Panel
from .grid import pick_best
from .sums import matrices, solved, summed

NAMES = ("p", "d", "q", "sp", "sd", "sq")
Order = tuple[int, int, int, int, int, int]
LAGS = 3  # most one-step lags of values and of residuals
LONG = 6  # lags of the long autoregression
#: Columns of an order: constant, values one to LAGS steps before, value a season before, and residuals alike.
TERMS = ("constant", *(f"ar{k}" for k in range(1, LAGS + 1)), "season_ar", *(f"ma{k}" for k in range(1, LAGS + 1)), "season_ma")
SIZE = len(TERMS)
#: When each column is used, in any dialect.
USED = ("d + sd = 0", *(f"p >= {k}" for k in range(1, LAGS + 1)), "sp > 0", *(f"q >= {k}" for k in range(1, LAGS + 1)), "sq > 0")
COUNT = "p + q + sp + sq + CASE WHEN d + sd = 0 THEN 1 ELSE 0 END"


def arima_orders(limit: int = 4) -> list[Order]:
    """All (p, d, q) below ``limit``, without seasonal terms."""
    span = range(limit)
    return [(p, d, q, 0, 0, 0) for p in span for d in span for q in span]


def sarima_orders(limit: int = 2) -> list[Order]:
    """All (p, d, q, sp, sd, sq) below ``limit``."""
    span = range(limit)
    return [(p, d, q, sp, sd, sq) for p in span for d in span for q in span for sp in span for sd in span for sq in span]


def differencings(orders: Sequence[Order]) -> list[tuple[int, int]]:
    return sorted({(o[1], o[4]) for o in orders})


def polynomial(d: int, sd: int, period: int) -> list[float]:
    """Weights of the values one, two, ... steps before in a value that is d and sd times differenced, sign turned."""
    out = [1.0]
    for lag in [1] * d + [period] * sd:
        shifted = [0.0] * lag + out
        out = [a - b for a, b in zip(out + [0.0] * lag, shifted, strict=True)]
    return [-x for x in out[1:]]


def reach(orders: Sequence[Order], period: int) -> tuple[int, int]:
    """How many values and residuals before a row its regressors need."""
    values = max([o[0] for o in orders] + [period * (o[3] > 0) for o in orders])
    residuals = max([o[2] for o in orders] + [period * (o[5] > 0) for o in orders])
    return values, residuals


def _differenced(panel: Panel, wanted: Sequence[tuple[int, int]], holdout: int, period: int) -> DataFrame:
    """A row per (keys, differencing, time): ``w`` and its lags, the centred value ``y``, and whether it trains."""
    keys = [*panel.keys]
    whole = Window.partitionBy(*keys)
    w = whole.orderBy(panel.ts)
    rows = panel.df.where(panel.has_key).select(*keys, panel.ts, F.col(panel.y).cast("double").alias("y"))
    rows = rows.withColumns({"_n": F.count(F.lit(1)).over(whole), "_rn": F.row_number().over(w)})
    trains = F.col("_rn") <= F.col("_n") - holdout
    rows = rows.withColumn("_mean", F.avg(F.when(trains, F.col("y"))).over(whole)).withColumn("y", F.col("y") - F.col("_mean"))
    made = {(0, 0): "y"}
    steps = {(i, sd) for d, sd in wanted for i in range(d + 1)} | {(0, i) for _, sd in wanted for i in range(sd + 1)}
    for d, sd in sorted(steps, key=lambda x: (x[1], x[0])):
        if (d, sd) not in made:
            before, lag = (made[d - 1, sd], 1) if d else (made[0, sd - 1], period)
            made[d, sd] = f"_w{d}_{sd}"
            rows = rows.withColumn(made[d, sd], F.col(before) - F.lag(before, lag).over(w))
    lags = sorted({*range(1, LONG + 1), period})
    rows = rows.withColumns({f"{made[x]}_{k}": F.lag(made[x], k).over(w) for x in wanted for k in lags})

    def one(i: int, x: tuple[int, int]) -> Column:
        values = [F.col(f"{made[x]}_{k}").alias(f"w{k}") for k in lags]
        return F.struct(F.lit(i).alias("dd"), F.lit(float(sum(x) == 0)).alias("c"), F.col(made[x]).alias("w"), *values)

    listed = F.explode(F.array(*(one(i, x) for i, x in enumerate(wanted)))).alias("_x")
    return rows.select(*keys, F.col("_rn").alias("rn"), "_mean", trains.alias("trains"), "y", listed).select(*keys, "rn", "_mean", "trains", "y", "_x.*")


def _long_fits(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The long autoregression of every (keys, differencing): ``_a0`` to ``_a6``."""
    size = LONG + 1
    known = F.col("trains") & F.col("w").isNotNull() & F.col(f"w{LONG}").isNotNull()
    columns = [F.col("c"), *(F.col(f"w{k}") for k in range(1, size))]
    cases = rows.select(*keys, "dd", F.when(known, F.col("w")).alias("w"), *(F.when(known, c).alias(f"x{i}") for i, c in enumerate(columns)))
    sums = summed(cases, [*keys, "dd"], size)
    names = [f"_of{i}" for i in range(len(keys))]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t, ww = matrices(batch, size)
            b, _, _ = solved(s, t, ww, np.ones_like(t, bool))
            yield pa.record_batch([*batch.columns[: len(keys) + 1], *(pa.array(b[:, i]) for i in range(size))], names=[*names, "_dd", *(f"_a{i}" for i in range(size))])

    fields = [T.StructField(n, sums.schema[k].dataType) for n, k in zip([*names, "_dd"], [*keys, "dd"], strict=True)]
    return sums.mapInArrow(solve, T.StructType([*fields, *(T.StructField(f"_a{i}", T.DoubleType()) for i in range(size))]))


def _paths(order: Order, b: np.ndarray, tails: dict[str, np.ndarray], horizon: int, period: int) -> np.ndarray:
    """Forecasts of an order, a row per series, from its coefficients and the series' last rows."""
    w, e, y = (tails[k] for k in ("w", "e", "y"))
    weights = polynomial(order[1], order[4], period)
    for _ in range(horizon):
        value = b[:, 0].copy()
        for i, (a, k) in enumerate([(w, 1), (w, 2), (w, 3), (w, period), (e, 1), (e, 2), (e, 3), (e, period)], 1):
            if k <= a.shape[1]:
                value += np.where(b[:, i] != 0, b[:, i] * a[:, -k], 0)
        level = value + sum((c * y[:, -k] for k, c in enumerate(weights, 1) if c and k <= y.shape[1]), np.zeros(len(value)))
        w, y, e = np.column_stack([w, value]), np.column_stack([y, level]), np.column_stack([e, np.zeros(len(value))])
    return y[:, y.shape[1] - horizon :]


def order_fits(panel: Panel, orders: Sequence[Order], holdout: int = 0, period: int = 12, horizon: int = 0) -> DataFrame:
    """Every order on every series but its last ``holdout`` values.

    ``keys``, ``grid_id``, the order, ``n``, ``aic``, ``status``, the coefficients ``b`` (see ``TERMS``) and their ``errors``, the
    ``forecast`` of ``horizon`` values and the ``actual`` ones held out.
    """
    keys = [*panel.keys]
    wanted = differencings(orders)
    values, residuals = reach(orders, period)
    rows = _differenced(panel, wanted, holdout, period)
    if residuals:
        first = _long_fits(rows, keys)
        same = F.col("dd") == F.col("_dd")
        for i, k in enumerate(keys):
            same &= F.col(k) == F.col(f"_of{i}")
        guess = F.col("_a0") * F.col("c")
        for k in range(1, LONG + 1):
            guess = guess + F.col(f"_a{k}") * F.col(f"w{k}")
        rows = rows.join(first, same).withColumn("e", F.when(F.col("trains"), F.col("w") - guess))
        by = Window.partitionBy(*keys, "dd").orderBy("rn")
        rows = rows.withColumns({f"e{k}": F.lag("e", k).over(by) for k in {*range(1, LAGS + 1), period}})
    else:
        rows = rows.withColumn("e", F.lit(0.0))
    most, none = [max(o[i] for o in orders) for i in range(6)], F.lit(0.0)
    x = [F.col("c"), *(F.col(f"w{k}") if most[0] >= k else none for k in range(1, LAGS + 1)), F.col(f"w{period}") if most[3] else none]
    x += [*(F.col(f"e{k}") if most[2] >= k else none for k in range(1, LAGS + 1)), F.col(f"e{period}") if most[5] else none]
    known = F.col("trains") & F.col("w").isNotNull()
    for column in x:
        known &= column.isNotNull()
    kept = max(values, residuals, max(d + period * sd for d, sd in wanted), 1)
    cases = rows.select(*keys, "dd", "rn", "y", "trains", "_mean", F.col("w").alias("value"), "e", F.when(known, F.col("w")).alias("w"), *(F.when(known, c).alias(f"x{i}") for i, c in enumerate(x)))
    cases = cases.withColumn("_end", F.max(F.when(F.col("trains"), F.col("rn"))).over(Window.partitionBy(*keys, "dd")))
    # At most so many rows of a series: what recursions look back to, and what was held out.
    last = F.when(F.col("trains") & (F.col("rn") > F.col("_end") - kept), F.struct("rn", F.col("value").alias("w"), "e", "y"))
    more = {
        "tail": F.sort_array(F.collect_list(last)),
        "later": F.sort_array(F.collect_list(F.when(~F.col("trains"), F.struct("rn", (F.col("y") + F.col("_mean")).alias("y"))))),
        "_mean": F.first("_mean"),
    }
    found = summed(cases, [*keys, "dd"], SIZE, more)
    for name in ("w", "e", "y"):
        found = found.withColumn(f"tail_{name}", F.expr(f"transform(tail, r -> coalesce(r.{name}, 0D))"))
    found = found.withColumn("actual", F.transform("later", lambda r: r["y"])).drop("tail", "later")
    listed = [[(i, o) for i, o in enumerate(orders) if (o[1], o[4]) == x] for x in wanted]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            which = whole.column("dd").to_numpy()
            for dd, mine in enumerate(listed):
                batch = whole.filter(pa.array(which == dd))
                if not batch.num_rows:
                    continue
                s, t, ww = matrices(batch, SIZE)
                n = batch.column("n").to_numpy()
                mean = batch.column("_mean").to_numpy(zero_copy_only=False)
                tails = {}
                for name in ("w", "e", "y"):
                    tails[name] = np.zeros((len(n), kept))
                    for i, tail in enumerate(batch.column(f"tail_{name}").to_pylist()):
                        tails[name][i, kept - len(tail) :] = tail
                for grid_id, o in mine:
                    use = [o[1] + o[4] == 0, *(o[0] >= k for k in range(1, LAGS + 1)), o[3] > 0, *(o[2] >= k for k in range(1, LAGS + 1)), o[5] > 0]
                    b, squares, inverse = solved(s, t, ww, np.tile(use, (len(n), 1)))
                    k = sum(use)
                    fine = (n > k + 1) & (squares > 0)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        aic = n * np.log(squares / n) + 2 * (k + 1)
                        errors = np.sqrt((squares / (n - k))[:, None] * inverse)
                    lists = {"b": b, "errors": errors, "forecast": _paths(o, b, tails, horizon, period) + mean[:, None]}
                    yield pa.record_batch(
                        [
                            *batch.columns[: len(keys)],
                            pa.array(np.full(len(n), grid_id, np.int32)),
                            *(pa.array(np.full(len(n), v, np.int32)) for v in o),
                            batch.column("n"),
                            pa.array(aic, mask=~fine),
                            pa.array(np.where(fine, "ok", "too few values or no error left"), pa.string()),
                            *(pa.array([x if ok else None for x, ok in zip(v, fine, strict=True)], pa.list_(pa.float64())) for v in lists.values()),
                            batch.column("actual"),
                        ],
                        names=names,
                    )

    names = [*keys, "grid_id", *NAMES, "n", "aic", "status", "b", "errors", "forecast", "actual"]
    numbers = "array<double>"
    kinds = ["int"] * (1 + len(NAMES)) + ["long", "double", "string", numbers, numbers, numbers, numbers]
    fields = [found.schema[k] for k in keys] + [T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(names[len(keys) :], kinds, strict=True)]
    return found.mapInArrow(solve, T.StructType(fields))


def order_scores(panel: Panel, orders: Sequence[Order], holdout: int = 0, period: int = 12) -> DataFrame:
    """Rows (keys, grid_id, order, n, aic, status): every order on every series but its last ``holdout`` values."""
    return order_fits(panel, orders, holdout, period).select(*panel.keys, "grid_id", *NAMES, "n", "aic", "status")


def holdout_errors(fits: DataFrame) -> DataFrame:
    """Fits with ``mae``: the mean absolute error of their forecasts on the values held out."""
    gaps = F.zip_with("forecast", "actual", lambda a, b: F.abs(a - b))
    known = (F.size("actual") > 0) & (F.size("actual") == F.size("forecast"))
    return fits.withColumn("mae", F.when(known, F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b) / F.size("actual")))


def best_order(scores: DataFrame, keys: Sequence[str], metric: str = "aic", more: Sequence[str] = ()) -> DataFrame:
    """The order with the least AIC (or another ``metric``) of every series; ``more`` columns come along."""
    chosen = [n for n in (*NAMES, *more) if n != metric]
    return pick_best(scores, keys, metric, chosen)


def forecasts(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, order, step, prediction, actual) of the forecasts of fits; ``actual`` where it was held out."""
    each = F.posexplode(F.arrays_zip("forecast", "actual")).alias("step", "_pair")
    rows = fits.where("forecast IS NOT NULL").select(*keys, *NAMES, each)
    return rows.select(*keys, *NAMES, (F.col("step") + 1).alias("step"), F.col("_pair.forecast").alias("prediction"), F.col("_pair.actual").alias("actual"))


def coefficient_table(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, order, parameter, value, error) of the coefficients that an order has."""
    each = F.array(*(F.when(F.expr(used), F.struct(F.lit(name).alias("parameter"), F.col("b")[i].alias("value"), F.col("errors")[i].alias("error"))) for i, (name, used) in enumerate(zip(TERMS, USED, strict=True))))
    listed = F.explode(F.filter(each, lambda c: c.isNotNull())).alias("_c")
    return fits.where("status = 'ok'").select(*keys, *NAMES, listed).select(*keys, *NAMES, "_c.*")


def refitted(panel: Panel, best: DataFrame, orders: Sequence[Order], period: int = 12, horizon: int = 0) -> DataFrame:
    """The fit on all values of the order chosen for each series (``grid_id`` of ``best``)."""
    chosen = best.where(F.col("grid_id").isNotNull()).select(*panel.keys, "grid_id")
    return order_fits(panel, orders, 0, period, horizon).join(chosen, [*panel.keys, "grid_id"])
