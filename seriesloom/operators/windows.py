"""Row-positional features of each series.

All operators use the panel's one ordered window, so any number of them in a
row costs one shuffle and one sort. Frames are never wider than a running total
or a single offset: the work per row does not grow with the window length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import alpha_text, ewm_name, lag_name, roll_name
from ..functions.transforms import noise
from ..panel import Panel

# Weights below this are lost in a double next to the newest weight, which is 1.
NEGLIGIBLE_WEIGHT = 1e-18


def _noisy(value: Column, noise_sd: float, seed: int) -> Column:
    return value + noise(noise_sd, seed) if noise_sd else value


def lag_features(
    panel: Panel, lags: Sequence[int], noise_sd: float = 0.0, seed: int = 7
) -> Panel:
    """The value ``k`` rows earlier in the same series, for every ``k``."""
    panel = panel.spread_null_keys()
    w = panel.window()
    back = max(lags, default=0) if min(lags, default=0) >= 0 else math.inf
    return panel.looking_back(back).with_df(
        panel.df.withColumns(
            {
                lag_name(panel.y, k): _noisy(
                    panel.of_series(F.lag(panel.y, k).over(w)), noise_sd, seed + i
                )
                for i, k in enumerate(lags)
            }
        )
    )


def rolling_means(panel: Panel, sizes: Sequence[int], shift: int = 0) -> Panel:
    """Plain means of the last ``n`` rows, ``shift`` rows back; NULL unless all ``n`` are known.

    Meant for short previews; see :func:`triangular_means` for long windows.
    """
    panel = panel.spread_null_keys()
    w = panel.window()
    columns = {}
    for n in sizes:
        frame = w.rowsBetween(-(n - 1) - shift, -shift)
        mean = F.when(F.count(panel.y).over(frame) == n, F.avg(panel.y).over(frame))
        columns[f"roll{n}" + (f"_shift{shift}" if shift else "")] = panel.of_series(mean)
    return panel.looking_back(max(sizes, default=1) - 1 + shift).with_df(panel.df.withColumns(columns))


def triangular_means(
    panel: Panel,
    sizes: Sequence[int],
    min_known: int = 10,
    noise_sd: float = 0.0,
    seed: int = 7,
) -> Panel:
    """Means of the ``n`` rows before the current one with triangular weights.

    The weights rise linearly to the middle of the window and fall again. Missing
    values and rows before the start carry no weight; the result is NULL where
    fewer than ``min_known`` values are known.

    Within one half a weight is linear in the row number. So each half is a
    difference of running totals of y and of row number times y, and likewise
    for the total weight: four running totals serve windows of all lengths.
    """
    if not sizes:
        return panel
    panel = panel.spread_null_keys()
    w = panel.window()
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.col(panel.y).isNotNull().cast("double")
    # A weighted mean moves with its values, so the series mean is taken off first:
    # the running totals then stay small and their differences keep their digits.
    value = F.coalesce(F.col(panel.y).cast("double") - F.col("_centre"), F.lit(0.0))
    numbered = panel.df.withColumns(
        {
            "_rn": F.row_number().over(w).cast("double"),
            "_centre": F.avg(panel.y).over(panel.group_window()),
        }
    )
    totals = numbered.withColumns(
        {
            "_sy": F.sum(value).over(running),
            "_sry": F.sum(F.col("_rn") * value).over(running),
            "_sk": F.sum(known).over(running),
            "_srk": F.sum(F.col("_rn") * known).over(running),
        }
    )
    offsets = sorted({o for n in sizes for o in (1, n - (n + 1) // 2 + 1, n + 1)})
    names = ("_sy", "_sry", "_sk", "_srk")
    lagged = totals.withColumns(
        {f"{c}_{o}": F.lag(c, o, 0.0).over(w) for o in offsets for c in names}
    )

    columns = {}
    for i, n in enumerate(sizes):
        rising = (n + 1) // 2
        old, mid, new = n + 1, n - rising + 1, 1
        scale = 2.0 / (n + 1) if n % 2 else 1.0 / n
        step = 1.0 if n % 2 else 2.0  # weight gained per row, in units of ``scale``
        half_step = 0.0 if n % 2 else 1.0

        def between(total: str, early: int, late: int) -> Column:
            return F.col(f"{total}_{late}") - F.col(f"{total}_{early}")

        def weighted(flat: str, sloped: str) -> Column:
            up = step * between(sloped, old, mid) + (
                step * (F.lit(float(n + 1)) - F.col("_rn")) - half_step
            ) * between(flat, old, mid)
            down = (step * F.col("_rn") - half_step) * between(flat, mid, new) - step * between(
                sloped, mid, new
            )
            return F.lit(scale) * (up + down)

        mean = F.when(
            between("_sk", old, new) >= min_known,
            F.col("_centre") + weighted("_sy", "_sry") / weighted("_sk", "_srk"),
        )
        columns[roll_name(panel.y, n)] = _noisy(panel.of_series(mean), noise_sd, seed + i)
    scratch = ["_rn", "_centre", *names, *[f"{c}_{o}" for o in offsets for c in names]]
    return panel.looking_back(max(sizes)).with_df(lagged.withColumns(columns).drop(*scratch))


def _doublings(alpha: float) -> int:
    """Doublings until the window is long enough for the oldest weight to be negligible."""
    if not 0.0 < alpha <= 1.0:
        raise ValueError("alpha must be in (0, 1]")
    if alpha == 1.0:
        return 0
    rows = math.log(NEGLIGIBLE_WEIGHT) / math.log(1.0 - alpha)
    return max(0, math.ceil(math.log2(rows)))


def _exponential_means(panel: Panel, alphas: Sequence[float], prefix: str) -> tuple[DataFrame, list[str]]:
    """One column per alpha: the exponentially weighted mean up to and with each row."""
    w = panel.window()
    known = F.col(panel.y).isNotNull()
    num = {a: f"_num_{alpha_text(a)}" for a in alphas}
    den = {a: f"_den_{alpha_text(a)}" for a in alphas}
    df = panel.df.withColumns(
        {num[a]: F.coalesce(F.col(panel.y).cast("double"), F.lit(0.0)) for a in alphas}
        | {den[a]: known.cast("double") for a in alphas}
    )
    # After step i a row holds the weighted totals of the last 2**(i+1) rows.
    for i in range(max(_doublings(a) for a in alphas)):
        rows = 2**i
        grown = {}
        for a in alphas:
            if i >= _doublings(a):
                continue
            decay = (1.0 - a) ** rows
            for c in (num[a], den[a]):
                grown[c] = F.col(c) + F.lit(decay) * F.lag(c, rows, 0.0).over(w)
        df = df.withColumns(grown)
    # A missing row shrinks both totals alike, so it keeps the mean of the last known row.
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = {a: f"{prefix}{alpha_text(a)}" for a in alphas}
    df = df.withColumns(
        {
            names[a]: F.last(
                F.when(known, F.col(num[a]) / F.col(den[a])), ignorenulls=True
            ).over(so_far)
            for a in alphas
        }
    )
    return df.drop(*num.values(), *den.values()), list(names.values())


def ewm_means(panel: Panel, alphas: Sequence[float], shift: int = 1) -> Panel:
    """Exponentially weighted means of the rows up to ``shift`` rows back."""
    panel = panel.spread_null_keys()
    df, names = _exponential_means(panel, alphas, "ewm")
    if shift:
        w = panel.window()
        df = df.withColumns({c: panel.of_series(F.lag(c, shift).over(w)) for c in names})
    # Behind a gap of any length stands the mean of the last known row.
    return panel.looking_back(math.inf).with_df(df)


def ewm_features(panel: Panel, alphas: Sequence[float], lags: Sequence[int]) -> Panel:
    """Exponentially weighted means for every (alpha, lag).

    The mean of a lagged series is the lagged mean of the series, so each alpha
    is worked out once and every lag of it is a plain offset. Each mean is built
    by doubling: totals over 2m rows are those over m rows plus the decayed
    totals of the m rows before. Six offsets cover 64 rows, which for alpha .5
    leaves out weights below 1e-19.
    """
    if not alphas or not lags:
        return panel
    panel = panel.spread_null_keys()
    df, names = _exponential_means(panel, alphas, "_ewm")
    w = panel.window()
    df = df.withColumns(
        {
            ewm_name(panel.y, a, k): panel.of_series(F.lag(c, k).over(w))
            for a, c in zip(alphas, names)
            for k in lags
        }
    )
    return panel.looking_back(math.inf).with_df(df.drop(*names))


def first_rows(panel: Panel, n: int = 5) -> Panel:
    """The first ``n`` rows of every series, in time order."""
    df = panel.df.where(panel.has_key) if panel.null_keys else panel.df
    numbered = df.withColumn("_rn", F.row_number().over(panel.window()))
    return panel.looking_back(math.inf).with_df(numbered.where(F.col("_rn") <= n).drop("_rn"))


def calendar_spine(panel: Panel, period: str = "day") -> Panel:
    """Every period between the first and last of each series, with NULL where none was measured.

    Each row brings the periods up to the next row of its series with it, so the
    gaps are filled on the partitioning of the window, without a join. Rows that
    do not start a period, and several rows of one period, are errors.
    """
    if period not in ("hour", "day", "week", "month"):
        raise ValueError(f"unknown period {period!r}")
    df = panel.df.where(panel.has_key) if panel.null_keys else panel.df
    step = F.expr(f"interval 1 {period}")
    following = F.lead(panel.ts).over(panel.window())
    kind = df.schema[panel.ts].dataType
    start = F.date_trunc(period, panel.ts).cast(kind)

    def error(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{text} {period}: "), F.col(panel.ts).cast("string"))).cast(kind)

    until = (
        F.when(F.col(panel.ts) != start, error("a row does not start its"))
        .when(following <= F.col(panel.ts), error("several rows of one"))
        .otherwise(F.coalesce(following - step, F.col(panel.ts)).cast(kind))
    )
    grown = df.withColumn("_until", until).select(
        *df.columns, F.posexplode(F.sequence(F.col(panel.ts), F.col("_until"), step)).alias("_gap", "_moment")
    )
    measured = F.col("_gap") == 0

    def column(c: str) -> Column:
        if c == panel.ts:
            return F.col("_moment").alias(c)
        return F.col(c) if c in panel.keys else F.when(measured, F.col(c)).alias(c)

    return panel.looking_back(math.inf).with_df(grown.select(*[column(c) for c in df.columns]))


def backward_fill(panel: Panel, into: str | None = None) -> Panel:
    """Replace a missing value by the next known one of the series."""
    panel = panel.spread_null_keys()
    # Read from the end, the next known value is the last one seen: a running frame.
    w = Window.partitionBy(*panel.partition_columns()).orderBy(F.col(panel.ts).desc())
    seen = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.last(panel.y, ignorenulls=True).over(seen)
    filled = F.coalesce(F.col(panel.y), panel.of_series(filled))
    return panel.looking_back(math.inf).with_df(panel.df.withColumn(into or panel.y, filled))
