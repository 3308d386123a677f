"""Exponential smoothing: forecasts, parameter search and refits over many series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import smoothing, windows
from ..operators.grid import Grid, float_range
from ..sources import tables
from .features import monthly_panel
from .registry import MONTHLY, day, num, query, shown

HOLDOUT = 12
AHEAD = 6
STEP_10 = float_range(0.01, 1.0, 0.10)
STEP_20 = float_range(0.10, 1.0, 0.20)
FINE = float_range(0.8, 1.0, 0.01)
SES_GRID = Grid({"alpha": STEP_10})
SES_FINE_GRID = Grid({"alpha": FINE})
DES_GRID = Grid({"alpha": STEP_10, "beta": STEP_10})
TES_GRID = Grid({"alpha": STEP_20, "beta": STEP_20, "gamma": STEP_20})
KEYS = ["supplier"]
FIXED = {"alpha": 0.5, "beta": 0.5, "gamma": 0.5}


def arrays(spark, folder):
    return smoothing.series_arrays(monthly_panel(spark, folder))


def split(spark, folder):
    return smoothing.split_last(arrays(spark, folder), HOLDOUT)


# --- the recurrences in SQL ---------------------------------------------------


def grid_cte(grid: Grid) -> str:
    """A grid as a table, by the place of each value in its list."""
    names = list(grid.axes)
    rest, place, parts = "i", grid.size, []
    for n in names:
        values = grid.axes[n]
        place //= len(values)
        parts.append(f"CAST(({list(values)})[(({rest} // {place}) % {len(values)}) + 1] AS DOUBLE) AS {n}")
    return f"""grid AS (
  SELECT CAST(i AS INTEGER) AS grid_id, {', '.join(parts)} FROM range({grid.size}) r(i))"""


def fixed_cte(names: str) -> str:
    return "grid AS (SELECT 0 AS grid_id, " + ", ".join(
        f"CAST({FIXED[n]} AS DOUBLE) AS {n}" for n in names.split()
    ) + ")"


def fold_cte(method: str, last: str, init: str = "simple", source: str = "monthly", start: str = "monthly m CROSS JOIN grid g", params: str = "") -> str:
    """CTE ``fold`` with the state of every (series, grid point) after each row.

    ``last`` is the last row number to take in, in terms of n.
    """
    link = f"FROM fold f JOIN {source} m ON m.supplier = f.supplier AND m.rn = f.rn + 1 WHERE m.rn <= {last}"
    key = "m.supplier, m.rn, m.n, g.grid_id"
    nxt = "m.supplier, m.rn, m.n, f.grid_id"
    if method == "single" and init == "simple":
        return f"""fold AS (
  SELECT {key}, g.alpha, m.y AS l, m.y AS l0 FROM {start} WHERE m.rn = 1
  UNION ALL SELECT {nxt}, f.alpha, f.alpha * m.y + (1 - f.alpha) * f.l, f.l0 {link})"""
    if method == "single":
        return f"""raw AS (
  SELECT {key}, g.alpha, g.alpha * m.y AS c, 1 - g.alpha AS g, m.y AS gr, CAST(1 AS DOUBLE) AS gg
  FROM {start} WHERE m.rn = 1
  UNION ALL SELECT {nxt}, f.alpha, f.alpha * m.y + (1 - f.alpha) * f.c, (1 - f.alpha) * f.g,
    f.gr + f.g * (m.y - f.c), f.gg + f.g * f.g
  {link.replace('FROM fold', 'FROM raw')}),
fold AS (SELECT supplier, rn, n, grid_id, alpha, c + g * gr / gg AS l, gr / gg AS l0 FROM raw)"""
    if method == "double" and init == "simple":
        return f"""starts AS (
  SELECT supplier, max(CASE WHEN rn = 1 THEN y END) AS l0, max(CASE WHEN rn = 2 THEN y END)
         - max(CASE WHEN rn = 1 THEN y END) AS b0 FROM {source} GROUP BY supplier),
fold AS (
  SELECT {key}, g.alpha, g.beta, s.l0 AS l, s.b0 AS b, s.l0, s.b0
  FROM {start} JOIN starts s ON s.supplier = m.supplier WHERE m.rn = 1
  UNION ALL SELECT {nxt}, f.alpha, f.beta, f.alpha * m.y + (1 - f.alpha) * (f.l + f.b),
    f.beta * (f.alpha * m.y + (1 - f.alpha) * (f.l + f.b) - f.l) + (1 - f.beta) * f.b, f.l0, f.b0
  {link})"""
    seasons = f"""starts AS (
  SELECT supplier, avg(y) FILTER (rn <= 12) AS l0, avg(y) FILTER (rn > 12 AND rn <= 24) AS second,
         list(y ORDER BY rn) FILTER (rn <= 12) AS first_year FROM {source} GROUP BY supplier)"""
    if method == "triple":
        up = "(f.l + f.b)"
        level = f"(f.alpha * (m.y - f.s[1]) + (1 - f.alpha) * {up})"
        return f"""{seasons},
fold AS (
  SELECT m.supplier, CAST(0 AS BIGINT) AS rn, m.n, g.grid_id, g.alpha, g.beta, g.gamma, s.l0 AS l, (s.second - s.l0) / 12 AS b,
         list_transform(s.first_year, lambda v: v - s.l0) AS s, s.l0, (s.second - s.l0) / 12 AS b0
  FROM {start} JOIN starts s ON s.supplier = m.supplier WHERE m.rn = 1
  UNION ALL SELECT {nxt}, f.alpha, f.beta, f.gamma, {level}, f.beta * ({level} - f.l) + (1 - f.beta) * f.b,
    list_append(f.s[2:], f.gamma * (m.y - {up}) + (1 - f.gamma) * f.s[1]), f.l0, f.b0
  {link})"""
    up = "(f.l * f.b)"
    level = f"(f.alpha * (m.y / f.s[1]) + (1 - f.alpha) * {up})"
    return f"""{seasons},
fold AS (
  SELECT m.supplier, CAST(0 AS BIGINT) AS rn, m.n, g.grid_id, g.alpha, g.beta, g.gamma, s.l0 AS l, pow(s.second / s.l0, 1.0 / 12) AS b,
         list_transform(s.first_year, lambda v: v / s.l0) AS s, s.l0, pow(s.second / s.l0, 1.0 / 12) AS b0
  FROM {start} JOIN starts s ON s.supplier = m.supplier WHERE m.rn = 1
  UNION ALL SELECT {nxt}, f.alpha, f.beta, f.gamma, {level}, f.beta * ({level} / f.l) + (1 - f.beta) * f.b,
    list_append(f.s[2:], f.gamma * (m.y / {up}) + (1 - f.gamma) * f.s[1]), f.l0, f.b0
  {link})"""


def ahead_sql(method: str, k: str) -> str:
    return {
        "single": "f.l",
        "double": f"f.l + {k} * f.b",
        "triple": f"f.l + {k} * f.b + f.s[(({k} - 1) % 12) + 1]",
        "triple_mul": f"f.l * pow(f.b, {k}) * f.s[(({k} - 1) % 12) + 1]",
    }[method]


def scores_cte(method: str) -> str:
    params = {"single": "alpha", "double": "alpha, beta"}.get(method, "alpha, beta, gamma")
    grouped = ", ".join(f"f.{p.strip()}" for p in params.split(","))
    return f"""scores AS (
  SELECT f.supplier, f.grid_id, {grouped}, avg(abs(t.y - ({ahead_sql(method, '(t.rn - f.rn)')}))) AS mae
  FROM fold f JOIN monthly t ON t.supplier = f.supplier AND t.rn > f.rn
  WHERE f.rn = f.n - {HOLDOUT} GROUP BY f.supplier, f.grid_id, {grouped})"""


def grid_sql(method: str, grid: Grid, init: str = "simple") -> str:
    """All CTEs of a parameter search up to ``scores``."""
    return f"WITH RECURSIVE {MONTHLY}, {grid_cte(grid)}, {fold_cte(method, f'm.n - {HOLDOUT}', init)}, {scores_cte(method)}"


def shown_params(grid: Grid) -> str:
    return ", ".join(num(p) for p in grid.axes)


def forecast_sql(method: str, names: str, init: str = "simple") -> str:
    ahead = ahead_sql(method, "k")
    return f"""WITH RECURSIVE {MONTHLY}, {fixed_cte(names)}, {fold_cte(method, 'm.n', init)},
ends AS (SELECT supplier, max(ts) AS last_ts FROM monthly GROUP BY supplier)
SELECT f.supplier, CAST(k AS INTEGER) AS step, {day('e.last_ts + to_months(CAST(k AS INTEGER))', 'ts')}, {num(ahead, 'prediction')}
FROM fold f JOIN ends e ON e.supplier = f.supplier CROSS JOIN range(1, {AHEAD + 1}) r(k)
WHERE f.rn = f.n"""


# --- queries ------------------------------------------------------------------


@query(
    "param_grid",
    f"""WITH {MONTHLY}, {grid_cte(TES_GRID)}, sizes AS (SELECT supplier, max(n) AS n FROM monthly GROUP BY supplier)
SELECT supplier, CAST(n AS INTEGER) AS n, grid_id, {shown_params(TES_GRID)} FROM sizes CROSS JOIN grid""",
)
def param_grid(spark, folder):
    """Every (series, grid point) to be evaluated, in product order."""
    series = arrays(spark, folder).select("supplier", F.size("y").alias("n"))
    return shown(TES_GRID.attach(series))


def _register_forecast(name: str, method: str, names: str, init: str = "simple") -> None:
    @query(name, forecast_sql(method, names, init))
    def run(spark, folder):
        params = {n: FIXED[n] for n in names.split()}
        return shown(smoothing.forecast(arrays(spark, folder), KEYS, method, AHEAD, params, init))


_register_forecast("ses_forecast", "single", "alpha")
_register_forecast("ses_forecast_ls", "single", "alpha", "ls")
_register_forecast("des_forecast", "double", "alpha beta")
_register_forecast("tes_forecast", "triple", "alpha beta gamma")
_register_forecast("tes_mul_forecast", "triple_mul", "alpha beta gamma")


def _register_grid(name: str, method: str, grid: Grid, init: str = "simple") -> None:
    @query(name, grid_sql(method, grid, init) + f"\nSELECT supplier, grid_id, {shown_params(grid)}, {num('mae')} FROM scores")
    def run(spark, folder):
        return shown(smoothing.grid_scores(split(spark, folder), KEYS, method, grid, init))


_register_grid("ses_grid", "single", SES_GRID)
_register_grid("ses_grid_ls", "single", SES_FINE_GRID, "ls")
_register_grid("des_grid", "double", DES_GRID)
_register_grid("tes_grid", "triple", TES_GRID)


def best_cte(grid: Grid) -> str:
    chosen = ", ".join(f"arg_min({p}, (CAST(mae AS FLOAT), grid_id)) AS {p}" for p in ("grid_id", *grid.axes, "mae"))
    return f"best AS (SELECT supplier, {chosen} FROM scores GROUP BY supplier)"


def _register_best(name: str, method: str, grid: Grid) -> None:
    @query(
        name,
        grid_sql(method, grid)
        + f", {best_cte(grid)}\nSELECT supplier, grid_id, {shown_params(grid)}, {num('mae')}, 'ok' AS status FROM best",
    )
    def run(spark, folder):
        return shown(smoothing.grid_best(split(spark, folder), KEYS, method, grid))


_register_best("ses_best", "single", SES_GRID)
_register_best("des_best", "double", DES_GRID)
_register_best("tes_best", "triple", TES_GRID)


METHOD_GRIDS = (("single", SES_GRID), ("double", DES_GRID), ("triple", TES_GRID))


@query(
    "method_comparison",
    "\nUNION ALL\n".join(
        f"SELECT '{method}' AS method, * FROM ({grid_sql(method, grid)}, {best_cte(grid)}\n"
        f"SELECT supplier, {num('mae')} FROM best)"
        for method, grid in METHOD_GRIDS
    ),
)
def method_comparison(spark, folder):
    """The best holdout error of every method for every series."""
    return shown(smoothing.compare_methods(split(spark, folder), KEYS, dict(METHOD_GRIDS)))


def _final_sql() -> str:
    refit = fold_cte("triple", "m.n", start="monthly m JOIN best g ON g.supplier = m.supplier")
    refit = refit.replace("starts AS", "starts2 AS").replace("JOIN starts s", "JOIN starts2 s")
    refit = refit.replace("fold AS (", "refit AS (", 1).replace("FROM fold f", "FROM refit f")
    return (
        grid_sql("triple", TES_GRID)
        + f""", {best_cte(TES_GRID)}, {refit},
ends AS (SELECT supplier, max(ts) AS last_ts FROM monthly GROUP BY supplier)
SELECT f.supplier, CAST(k AS INTEGER) AS step, {day('e.last_ts + to_months(CAST(k AS INTEGER))', 'ts')},
  {num(ahead_sql('triple', 'k'), 'prediction')}
FROM refit f JOIN ends e ON e.supplier = f.supplier CROSS JOIN range(1, {AHEAD + 1}) r(k)
WHERE f.rn = f.n"""
    )


@query("final_forecast", _final_sql())
def final_forecast(spark, folder):
    """Best holdout parameters of each series, refitted on all its values, six steps ahead."""
    return shown(smoothing.search_and_forecast(split(spark, folder), KEYS, "triple", TES_GRID, AHEAD))


# --- series of any length: monthly orders of every customer --------------------

CUSTOMER_MONTHLY = (
    MONTHLY.replace("lineitem", "orders").replace("l_suppkey", "o_custkey").replace("l_shipdate", "o_orderdate").replace("l_quantity", "o_totalprice")
)


def customer_split(spark, folder):
    spine = windows.calendar_spine(tables.monthly_orders(spark, folder), "month")
    return smoothing.split_last(smoothing.series_arrays(windows.backward_fill(spine)), HOLDOUT)


def _customers(sql: str) -> str:
    return sql.replace(MONTHLY, CUSTOMER_MONTHLY)


@query(
    "short_best",
    _customers(grid_sql("single", SES_GRID))
    + f""", {best_cte(SES_GRID)}, customers AS (SELECT DISTINCT supplier FROM monthly)
SELECT c.supplier, grid_id, {shown_params(SES_GRID)}, {num('mae')},
  CASE WHEN mae IS NULL THEN 'no usable error' ELSE 'ok' END AS status
FROM customers c LEFT JOIN best b ON b.supplier = c.supplier""",
)
def short_best(spark, folder):
    """The best weight of every customer's monthly orders; those of a year or less have none."""
    return shown(smoothing.grid_best(customer_split(spark, folder), KEYS, "single", SES_GRID))


@query(
    "short_forecast",
    _customers(grid_sql("single", SES_GRID))
    + f""", {best_cte(SES_GRID)},
weights AS (SELECT c.supplier, coalesce(b.alpha, 0.5) AS alpha, 0 AS grid_id FROM (SELECT DISTINCT supplier FROM monthly) c LEFT JOIN best b ON b.supplier = c.supplier),
"""
    + fold_cte("single", "m.n", start="monthly m JOIN weights g ON g.supplier = m.supplier").replace("fold AS (", "refit AS (", 1).replace("FROM fold f", "FROM refit f")
    + f""",
ends AS (SELECT supplier, max(ts) AS last_ts FROM monthly GROUP BY supplier)
SELECT f.supplier, CAST(k AS INTEGER) AS step, {day('e.last_ts + to_months(CAST(k AS INTEGER))', 'ts')}, {num('f.l', 'prediction')}
FROM refit f JOIN ends e ON e.supplier = f.supplier CROSS JOIN range(1, {AHEAD + 1}) r(k)
WHERE f.rn = f.n""",
)
def short_forecast(spark, folder):
    """Forecasts for every customer: best weight where there is a holdout, the default one elsewhere."""
    return shown(smoothing.search_and_forecast(customer_split(spark, folder), KEYS, "single", SES_GRID, AHEAD))


@query(
    "model_params",
    f"""WITH RECURSIVE {MONTHLY}, {fixed_cte('alpha beta gamma')}, {fold_cte('triple', 'm.n')},
ended AS (SELECT f.*, s.first_year FROM fold f JOIN starts s ON s.supplier = f.supplier WHERE f.rn = f.n)
"""
    + "\nUNION ALL\n".join(
        f"SELECT supplier, '{name}' AS parameter, {num(e, 'value')} FROM ended"
        for name, e in (
            *((p, p) for p in ("alpha", "beta", "gamma")),
            ("initial_level", "l0"),
            ("initial_trend", "b0"),
            *((f"initial_season_{i}", f"first_year[{i + 1}] - l0") for i in range(12)),
        )
    ),
)
def model_params(spark, folder):
    """Weights and start of a fit as rows."""
    return shown(smoothing.parameter_rows(arrays(spark, folder), KEYS, "triple", FIXED))
