"""Unit-root tests, all in expressions: least squares by eliminating the matrix of sums of products."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..panel import Panel
from .sums import SINGULAR

# Response surface of the constant-only Dickey-Fuller p-value
# (MacKinnon 1994), as polynomials in the statistic below and above the joint.
P_JOINT = -1.61
P_LOWEST, P_HIGHEST = -18.83, 2.74
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL_5 = -2.86

UNUSABLE = "too short, or with missing values"
COLLINEAR = "no error left, or collinear differences"
#: Terms of the two expansions of the normal distribution, and where the second one takes over.
TERMS, FAR = 60, 4.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def _below(count: Column) -> Column:
    """The whole numbers from 0 below ``count``."""
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def _dot(a: Column, b: Column) -> Column:
    """The sum of products of two arrays of one length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution: a series near 0, a continued fraction in the tails."""
    size = F.abs(z)
    density = F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    start = F.struct(size.alias("term"), size.alias("total"))

    def longer(s: Column, k: Column) -> Column:
        term = s["term"] * size * size / (2 * k + 1)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    ks = F.sequence(F.lit(1), F.lit(TERMS))
    near = F.lit(0.5) - density * F.aggregate(ks, start, longer, lambda s: s["total"])
    far = density / F.aggregate(F.reverse(ks), size, lambda x, k: size + k / x)
    upper = F.when(size < FAR, near).otherwise(far)
    return F.when(z > 0, 1 - upper).otherwise(upper)


def p_value(statistic: Column) -> Column:
    """Approximate p-value of a Dickey-Fuller statistic with a constant."""

    def polynomial(terms: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for c in reversed(terms):
            total = total * statistic + c
        return total

    z = F.when(statistic <= P_JOINT, polynomial(P_SMALL)).otherwise(polynomial(P_LARGE))
    inside = _let(z, normal_cdf)
    return F.when(statistic > P_HIGHEST, 1.0).when(statistic < P_LOWEST, 0.0).when(statistic.isNotNull(), inside)


def _moments(y: Column, dy: Column, first: Column, lags: Column, columns: Column) -> Column:
    """Sums of products over the differences from ``first`` on, as a matrix of the ``columns`` wanted.

    0 is a constant, 1 the level before, 2 and on the differences 1 to ``lags`` steps before, and ``lags`` + 2
    the difference itself. Only products with the difference itself are summed over the rows: moving both of a pair
    by a step takes one row in at the beginning and one out at the end.
    """
    end = F.size(dy)
    rows = end - first
    steps = F.sequence(F.lit(0), lags)

    def lagged(values: Column) -> Column:
        mine = F.slice(values, first + 1, rows)
        return _let(mine, lambda v: F.transform(steps, lambda h: _dot(v, F.slice(dy, first + 1 - h, rows))))

    def chain(gap: Column, apart: Column) -> Column:
        def step(c: Column, u: Column) -> Column:
            entered = F.get(dy, first - 1 - u) * F.get(dy, first - 1 - u - apart)
            left = F.get(dy, end - 1 - u) * F.get(dy, end - 1 - u - apart)
            return F.concat(c, F.array(F.element_at(c, -1) + entered - left))

        return F.aggregate(_below(lags - apart), F.array(gap), step)

    level = F.slice(y, first + 1, rows)
    sums = F.struct(
        F.aggregate(level, F.lit(0.0), lambda total, v: total + v).alias("level"),
        _let(level, lambda v: _dot(v, v)).alias("square"),
        F.transform(steps, lambda h: F.get(y, end - h) - F.get(y, first - h)).alias("one"),
        lagged(y).alias("cross"),
        F.transform(lagged(dy), chain).alias("gap"),
    )

    def matrix(s: Column) -> Column:
        def lag(c: Column) -> Column:
            return F.when(c == lags + 2, 0).otherwise(c - 1)

        def entry(i: Column, j: Column) -> Column:
            a, b = F.least(i, j), F.greatest(i, j)
            constant = F.when(b == 0, rows.cast("double")).when(b == 1, s["level"]).otherwise(F.get(s["one"], lag(b)))
            level = F.when(b == 1, s["square"]).otherwise(F.get(s["cross"], lag(b)))
            gap = F.get(F.get(s["gap"], F.abs(lag(i) - lag(j))), F.least(lag(i), lag(j)))
            return F.when(a == 0, constant).when(a == 1, level).otherwise(gap)

        return F.transform(columns, lambda i: F.transform(columns, lambda j: entry(i, j)))

    return _let(sums, matrix)


def _eliminated(matrix: Column, count: Column) -> Column:
    """What is left of the matrix ``m`` without its first ``count`` columns, and the squared error after each, ``errors``.

    From a column that adds nothing on, all is NULL.
    """

    def eliminate(s: Column, k: Column) -> Column:
        def left(m: Column) -> Column:
            rest = F.size(m) - 1
            usable = m[0][0] > SINGULAR * matrix[k][k]
            share = F.transform(F.slice(m[0], F.lit(2), rest), lambda v: v / m[0][0])

            def rows(share: Column) -> Column:
                return F.transform(F.slice(m, F.lit(2), rest), lambda row: F.zip_with(F.slice(row, F.lit(2), rest), share, lambda v, x: v - row[0] * x))

            return F.when(usable, _let(share, rows))

        def added(m: Column) -> Column:
            return F.struct(m.alias("m"), F.concat(s["errors"], F.array(F.element_at(F.element_at(m, -1), -1))).alias("errors"))

        return _let(_let(s["m"], left), added)

    start = F.struct(matrix.alias("m"), F.array().cast("array<double>").alias("errors"))
    return F.aggregate(_below(count), start, eliminate)


def _tested(y: Column, limit: Column) -> Column:
    """Lag count, rows and statistic of a series that is centred; lag counts up to ``limit`` on the same rows."""
    dy = F.transform(_below(F.size(y) - 1), lambda r: F.get(y, r + 1) - F.get(y, r))

    def chosen(dy: Column) -> Column:
        n = F.size(dy) - limit

        def score(error: Column, i: Column) -> Column:
            return F.when(error > 0, F.struct((n * F.log(error / n) + 2 * (i + 1)).alias("aic"), (i - 1).alias("lags")))

        def least(errors: Column) -> Column:
            # The first error is that of the constant alone.
            scores = F.transform(errors, score)
            usable = F.forall(F.slice(errors, 2, limit + 1), lambda e: F.coalesce(e > 0, F.lit(False)))
            return F.when(usable, F.array_min(F.slice(scores, 2, limit + 1))["lags"])

        columns = F.sequence(F.lit(0), limit + 2)
        errors = _let(_moments(y, dy, limit, limit, columns), lambda m: _eliminated(m, limit + 2))["errors"]
        return F.struct(dy.alias("dy"), _let(errors, least).alias("lags"))

    def fitted(c: Column) -> Column:
        dy, lags = c["dy"], c["lags"]
        used = F.size(dy) - lags

        def statistic(m: Column) -> Column:
            # The level comes last: its pivot is all that the other columns don't explain.
            squares, product = m[0][0], m[0][1]
            error = (m[1][1] - product * product / squares) / (used - lags - 2)
            return F.when(error > 0, product / squares / F.sqrt(error / squares))

        columns = F.concat(F.array(F.lit(0)), F.transform(_below(lags), lambda i: i + 2), F.array(F.lit(1), lags + 2))
        found = _let(_moments(y, dy, lags, lags, columns), lambda m: _eliminated(m, lags + 1))["m"]
        return F.when(lags.isNotNull(), F.struct(used.alias("n_used"), lags.alias("lags"), _let(found, statistic).alias("statistic")))

    return _let(_let(dy, chosen), fitted)


def adf_test(arrays: DataFrame, keys: list[str], max_lag: int | None = None) -> DataFrame:
    """The augmented test with a constant for every series array (``y``), the number of lags chosen by AIC.

    All lag counts are compared on the same rows; the chosen one is then fitted on every row it can use. A series that
    is too short, has missing values or a regressor that adds nothing has NULL results and a ``status``
    that says so ("ok" elsewhere).
    """
    n = F.size("y")
    most = F.ceil(12 * F.pow(n / 100, F.lit(0.25))).cast("int") if max_lag is None else F.lit(max_lag)
    limit = F.least(most, F.floor(n / 2).cast("int") - 2)
    known = F.forall("y", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    usable = F.coalesce(known & (limit >= 0), F.lit(False))
    # What cannot be tested is no array here, so that nothing is computed on it.
    mean = _let(F.aggregate("y", F.lit(0.0), lambda a, v: a + v) / n, lambda m: F.transform("y", lambda v: v - m))
    found = _let(F.when(usable, F.struct(mean.alias("y"), limit.alias("limit"))), lambda s: F.when(s.isNotNull(), _tested(s["y"], s["limit"])))
    rows = arrays.select(*keys, found.alias("_t"), usable.alias("_usable")).select(
        *keys, F.col("_t.n_used").alias("n_used"), F.col("_t.lags").alias("lags"), F.col("_t.statistic").alias("statistic"), "_usable"
    )
    status = F.when(~F.col("_usable"), UNUSABLE).when(F.col("statistic").isNull(), COLLINEAR).otherwise("ok")
    fine = F.col("statistic").isNotNull()
    p = p_value(F.col("statistic"))
    return rows.select(
        *keys,
        *(F.when(fine, F.col(c)).alias(c) for c in ("n_used", "lags")),
        "statistic",
        p.alias("p_value"),
        F.when(fine, F.lit(CRITICAL_5)).alias("critical_5"),
        (p < 0.05).alias("stationary"),
        status.alias("status"),
    )


def dickey_fuller(panel: Panel) -> DataFrame:
    """The plain test (no lagged differences) as regression aggregates, all inside the JVM."""
    panel = panel.spread_null_keys()
    df = panel.df.withColumn("_before", F.lag(panel.y).over(panel.window()))
    df = df.where(panel.has_key)
    change = F.col(panel.y) - F.col("_before")
    before = F.col("_before")
    fit = df.groupBy(*panel.keys).agg(
        F.regr_count(change, before).alias("n_used"),
        F.regr_slope(change, before).alias("_slope"),
        F.regr_sxx(change, before).alias("_sxx"),
        F.regr_sxy(change, before).alias("_sxy"),
        F.regr_syy(change, before).alias("_syy"),
    )
    variance = (F.col("_syy") - F.col("_slope") * F.col("_sxy")) / (F.col("n_used") - 2)
    statistic = F.when(
        (F.col("n_used") > 2) & (variance > 0), F.col("_slope") / F.sqrt(variance / F.col("_sxx"))
    )
    return fit.select(
        *panel.keys, "n_used", F.col("_slope").alias("slope"), statistic.alias("statistic")
    ).withColumn("below_critical_5", F.col("statistic") < CRITICAL_5)
