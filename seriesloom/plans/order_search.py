"""Searches over orders, their forecasts and coefficients, with the same sums and recursions in SQL."""

from __future__ import annotations

from ..operators import orders
from ..operators.sums import coefficients, elimination, in_sql, inverse_diagonal, products
from .features import monthly_panel
from .registry import MONTHLY, num, query, shown

HOLDOUT, AHEAD, PERIOD = 12, 6, 12
ARIMA = orders.arima_orders(4)
SARIMA = orders.sarima_orders(2)
KEYS = ["supplier"]
ORDER = ", ".join(orders.NAMES)
OVER = "OVER (PARTITION BY supplier ORDER BY rn)"


def _fits(listed, holdout: int) -> list[str]:
    """CTEs up to ``scored``: a row per series and order, with its coefficients."""
    wanted = orders.differencings(listed)
    values, residuals = orders.reach(listed, PERIOD)
    train = f"rn <= n - {holdout}"
    ctes = [
        f"base AS (SELECT supplier, rn, n AS months, {train} AS trains, CAST(y AS DOUBLE) AS raw FROM monthly)",
        "means AS (SELECT *, avg(CASE WHEN trains THEN raw END) OVER (PARTITION BY supplier) AS mean FROM base)",
        "d0 AS (SELECT supplier, rn, months, trains, mean, raw - mean AS y FROM means)",
    ]
    made, at = {(0, 0): "y"}, 0
    for d, sd in sorted({(i, sd) for d, sd in wanted for i in range(d + 1)} | {(0, i) for _, sd in wanted for i in range(sd + 1)}, key=lambda x: (x[1], x[0])):
        if (d, sd) not in made:
            before, lag = (made[d - 1, sd], 1) if d else (made[0, sd - 1], PERIOD)
            made[d, sd] = f"w{d}_{sd}"
            ctes.append(f"d{at + 1} AS (SELECT *, {before} - lag({before}, {lag}) {OVER} AS {made[d, sd]} FROM d{at})")
            at += 1
    lags = sorted({*range(1, orders.LONG + 1), PERIOD})
    ctes.append("lagged AS (SELECT *, " + ", ".join(f"lag({made[x]}, {k}) {OVER} AS {made[x]}_l{k}" for x in wanted for k in lags) + f" FROM d{at})")
    ctes.append("long AS (" + " UNION ALL ".join(f"SELECT supplier, rn, trains, mean, y, {i} AS dd, CAST({int(sum(x) == 0)} AS DOUBLE) AS c, {made[x]} AS w, " + ", ".join(f"{made[x]}_l{k} AS w{k}" for k in lags) + " FROM lagged" for i, x in enumerate(wanted)) + ")")
    if residuals:
        columns = ["c", *(f"w{k}" for k in range(1, orders.LONG + 1))]
        known = f"trains AND w IS NOT NULL AND w{orders.LONG} IS NOT NULL"
        ctes.append("first_x AS (SELECT supplier, dd, " + ", ".join(f"CASE WHEN {known} THEN {c} END AS {n}" for c, n in zip(["w", *columns], ["w", *(f"x{i}" for i in range(len(columns)))], strict=True)) + " FROM long)")
        sums = products(len(columns))
        ctes.append("first_s AS (SELECT supplier, dd, " + ", ".join(f"{e} AS {n}" for n, e in sums.items()) + " FROM first_x GROUP BY ALL)")
        ctes += in_sql(elimination(len(columns)) + coefficients(len(columns)), "first_s", "first_fit", sums)
        guess = " + ".join(f"b_{i} * {c}" for i, c in enumerate(columns))
        ctes.append(f"left_over AS (SELECT l.*, CASE WHEN trains THEN w - ({guess}) END AS e FROM long l JOIN (SELECT supplier, dd, {', '.join(f'b_{i}' for i in range(len(columns)))} FROM first_fit) USING (supplier, dd))")
        over = "OVER (PARTITION BY supplier, dd ORDER BY rn)"
        ctes.append("r AS (SELECT *, " + ", ".join(f"lag(e, {k}) {over} AS e{k}" for k in sorted({*range(1, orders.LAGS + 1), PERIOD})) + " FROM left_over)")
    else:
        ctes.append("r AS (SELECT *, CAST(0 AS DOUBLE) AS e FROM long)")
    most = [max(o[i] for o in listed) for i in range(6)]
    steps = range(1, orders.LAGS + 1)
    zero = "CAST(0 AS DOUBLE)"
    x = ["c", *(f"w{k}" if most[0] >= k else zero for k in steps), f"w{PERIOD}" if most[3] else zero]
    x += [*(f"e{k}" if most[2] >= k else zero for k in steps), f"e{PERIOD}" if most[5] else zero]
    known = " AND ".join(["trains", "w IS NOT NULL", *(f"{c} IS NOT NULL" for c in x if c not in ("c", zero))])
    ctes.append("cases AS (SELECT supplier, dd, mean, " + ", ".join(f"CASE WHEN {known} THEN {c} END AS {n}" for c, n in zip(["w", *x], ["w", *(f"x{i}" for i in range(len(x)))], strict=True)) + " FROM r)")
    sums = products(orders.SIZE)
    ctes.append("sums AS (SELECT supplier, dd, first(mean) AS mean, " + ", ".join(f"{e} AS {n}" for n, e in sums.items()) + " FROM cases GROUP BY supplier, dd)")
    rows = ", ".join(f"({i}, {wanted.index((o[1], o[4]))}, {', '.join(map(str, o))})" for i, o in enumerate(listed))
    ctes.append(f"listed(grid_id, dd, {ORDER}) AS (VALUES {rows})")
    ctes.append("offered AS (SELECT * FROM sums JOIN listed USING (dd))")
    ctes += in_sql(elimination(orders.SIZE, orders.USED) + coefficients(orders.SIZE) + inverse_diagonal(orders.SIZE), "offered", "solved", sums)
    k = f"({orders.COUNT})"
    ctes.append(f"scored AS (SELECT *, {k} AS k, CASE WHEN n > {k} + 1 AND ww > 0 THEN n * ln(ww / n) + 2 * ({k} + 1) END AS aic FROM solved)")
    kept = max(values, residuals, max(d + PERIOD * sd for d, sd in wanted), 1)
    ends = "(SELECT supplier, max(rn) FILTER (trains) AS last FROM base GROUP BY 1)"
    ctes.append("tails AS (SELECT supplier, dd, " + ", ".join(f"list(coalesce({c}, 0) ORDER BY rn) AS {n}" for c, n in (("w", "ws"), ("e", "es"), ("y", "ys"))) + f" FROM r JOIN {ends} USING (supplier) WHERE trains AND rn > last - {kept} GROUP BY 1, 2)")
    return [_kept(c) for c in ctes]


#: What later steps read more than once.
READ_AGAIN = ("long", "first_fit", "r", "sums", "scored", "tails", "base")


def _kept(cte: str) -> str:
    name, rest = cte.split(" AS ", 1)
    return f"{name} AS MATERIALIZED {rest}" if name in READ_AGAIN else cte


def _paths(listed, horizon: int, chosen: str = "scored") -> list[str]:
    """CTE ``paths``: forecasts of the orders in ``chosen``, step by step."""

    def back(a: str, k: int) -> str:
        return f"coalesce(f.{a}[len(f.{a}) - {k - 1}], 0)"

    value = ["CASE WHEN d + sd = 0 THEN b_0 ELSE 0 END"]
    value += [f"b_{k} * {back('ws', k)} + b_{orders.LAGS + 1 + k} * {back('es', k)}" for k in range(1, orders.LAGS + 1)]
    value += [f"b_{orders.LAGS + 1} * {back('ws', PERIOD)} + b_{orders.SIZE - 1} * {back('es', PERIOD)}"]
    undo = " ".join(f"WHEN {i} THEN " + (" + ".join(f"({a}) * {back('ys', j)}" for j, a in enumerate(orders.polynomial(d, sd, PERIOD), 1) if a) or "0") for i, (d, sd) in enumerate(orders.differencings(listed)))
    v = f"({' + '.join(value)})"
    return [
        f"chosen AS MATERIALIZED (SELECT * FROM {chosen} WHERE aic IS NOT NULL)",
        f"""paths AS (
  SELECT supplier, grid_id, 0 AS step, ws, es, ys FROM chosen JOIN tails USING (supplier, dd)
  UNION ALL
  SELECT f.supplier, f.grid_id, f.step + 1, list_append(f.ws, {v}), list_append(f.es, CAST(0 AS DOUBLE)), list_append(f.ys, {v} + CASE dd {undo} END)
  FROM paths f JOIN chosen s ON s.supplier = f.supplier AND s.grid_id = f.grid_id WHERE f.step < {horizon})""",
        "ahead AS (SELECT p.supplier, p.grid_id, step, ys[len(ys)] + mean AS prediction FROM paths p JOIN chosen s ON s.supplier = p.supplier AND s.grid_id = p.grid_id WHERE step > 0)",
    ]


def _with(*ctes: str) -> str:
    return f"WITH RECURSIVE {MONTHLY}, " + ",\n".join(ctes)


def _best(metric: str, source: str = "scored") -> str:
    chosen = ", ".join(f"arg_min({c}, (CAST({metric} AS FLOAT), grid_id)) FILTER ({metric} IS NOT NULL) AS {c}" for c in ("grid_id", *orders.NAMES, metric))
    return f"best AS MATERIALIZED (SELECT supplier, {chosen} FROM {source} GROUP BY supplier)"


ERRORS = f"""errors AS (
  SELECT a.supplier, a.grid_id, avg(abs(a.prediction - b.raw)) AS mae
  FROM ahead a JOIN base b ON b.supplier = a.supplier AND b.rn = b.months - {HOLDOUT} + a.step GROUP BY 1, 2),
measured AS MATERIALIZED (SELECT s.*, mae FROM scored s LEFT JOIN errors USING (supplier, grid_id))"""
STATUS = "CASE WHEN {} IS NULL THEN '{}' ELSE 'ok' END AS status"


def _register(name: str, listed) -> None:
    fits = _fits(listed, HOLDOUT)

    @query(f"{name}_grid", _with(*fits) + f"\nSELECT supplier, grid_id, {ORDER}, n, {num('aic')}, {STATUS.format('aic', 'too few values or no error left')} FROM scored")
    def grid(spark, folder):
        """The AIC of every order on every series but its last year."""
        return shown(orders.order_scores(monthly_panel(spark, folder), listed, HOLDOUT))

    @query(f"{name}_best", _with(*fits, _best("aic")) + f"\nSELECT supplier, grid_id, {ORDER}, {num('aic')}, {STATUS.format('aic', 'no usable error')} FROM best")
    def best(spark, folder):
        """The order with the least AIC."""
        return shown(orders.best_order(orders.order_scores(monthly_panel(spark, folder), listed, HOLDOUT), KEYS))


_register("arima", ARIMA)
_register("sarima", SARIMA)


@query(
    "sarima_best_mae",
    _with(*_fits(SARIMA, HOLDOUT), *_paths(SARIMA, HOLDOUT), ERRORS, _best("mae", "measured"))
    + f"\nSELECT supplier, grid_id, {ORDER}, {num('mae', digits=2)}, {STATUS.format('mae', 'no usable error')} FROM best",
)
def sarima_best_mae(spark, folder):
    """The seasonal order whose forecasts come nearest to the year held out."""
    fits = orders.holdout_errors(orders.order_fits(monthly_panel(spark, folder), SARIMA, HOLDOUT, horizon=HOLDOUT))
    return shown(orders.best_order(fits, KEYS, "mae"), 2)


@query(
    "arima_forecast",
    _with(*_fits(ARIMA, HOLDOUT), _best("aic"), *_paths(ARIMA, HOLDOUT, "(SELECT s.* FROM scored s JOIN (SELECT supplier, grid_id FROM best) USING (supplier, grid_id))"))
    + f"""\nSELECT a.supplier, {ORDER}, a.step, {num('b.raw', 'actual', 2)}, {num('a.prediction', 'prediction', 2)}
FROM ahead a JOIN chosen USING (supplier) JOIN base b ON b.supplier = a.supplier AND b.rn = b.months - {HOLDOUT} + a.step""",
)
def arima_forecast(spark, folder):
    """Forecasts of the best order by AIC beside the year held out."""
    fits = orders.order_fits(monthly_panel(spark, folder), ARIMA, HOLDOUT, horizon=HOLDOUT)
    return shown(orders.forecasts(orders.best_order(fits, KEYS, more=["forecast", "actual"]), KEYS), 2)


_FINAL = [*_fits(SARIMA, HOLDOUT), _best("aic"), "picked AS (SELECT supplier, grid_id FROM best)"]


def _refit() -> list[str]:
    """The fits on all values, under other names, of the orders picked on all but the last year."""
    names = {cte.split(" AS ", 1)[0].split("(")[0].strip() for cte in _fits(SARIMA, 0)}
    out = []
    for cte in _fits(SARIMA, 0):
        for name in sorted(names, key=len, reverse=True):
            cte = _renamed(cte, name)
        out.append(cte)
    return out


def _renamed(sql: str, name: str) -> str:
    import re

    return re.sub(rf"(^|FROM |JOIN ){name}\b", rf"\g<1>all_{name}", sql)


_WHOLE = [*_FINAL, *_refit()]
_AGAIN = "(SELECT s.* FROM all_scored s JOIN picked USING (supplier, grid_id))"


@query(
    "sarima_final",
    _with(*_WHOLE, *[c.replace("JOIN tails USING", "JOIN all_tails USING") for c in _paths(SARIMA, AHEAD, _AGAIN)])
    + f"\nSELECT a.supplier, {ORDER}, a.step, {num('a.prediction', 'prediction', 2)} FROM ahead a JOIN chosen USING (supplier)",
)
def sarima_final(spark, folder):
    """The best seasonal order by AIC, fitted again on all values, half a year ahead."""
    panel = monthly_panel(spark, folder)
    best = orders.best_order(orders.order_scores(panel, SARIMA, HOLDOUT), KEYS)
    return shown(orders.forecasts(orders.refitted(panel, best, SARIMA, horizon=AHEAD), KEYS).drop("actual"), 2)


@query(
    "order_params",
    _with(*_WHOLE, f"chosen AS MATERIALIZED (SELECT * FROM {_AGAIN} WHERE aic IS NOT NULL)")
    + "\n"
    + " UNION ALL ".join(
        f"SELECT supplier, {ORDER}, '{name}' AS parameter, {num(f'b_{i}', 'value')}, {num(f'sqrt(ww / (n - k) * i_{i})', 'error')} FROM chosen WHERE {used}"
        for i, (name, used) in enumerate(zip(orders.TERMS, orders.USED, strict=True))
    ),
)
def order_params(spark, folder):
    """Coefficients of the best seasonal order, with their standard errors."""
    panel = monthly_panel(spark, folder)
    best = orders.best_order(orders.order_scores(panel, SARIMA, HOLDOUT), KEYS)
    return shown(orders.coefficient_table(orders.refitted(panel, best, SARIMA), KEYS))
