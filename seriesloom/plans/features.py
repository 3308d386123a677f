"""Per-series features: lags, rolling and exponential means, decomposition, noise."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import alpha_text
from ..operators import combine, windows
from ..operators.decompose import component_means, components_long, decompose
from ..operators.segments import backward_fill_long, over_segments
from ..panel import Panel
from ..sources import tables
from .registry import DENSE, MONTHLY, SALES, SPARSE, day, num, query, rounded, rounded_in_batches, shown

LAGS = (91, 98, 105, 112, 119, 126, 182, 364, 546, 728)
ALPHAS = (0.95, 0.9, 0.8, 0.7, 0.5)
EWM_LAGS = (91, 98, 105, 112, 180, 270, 365, 546, 728)
ROLL_SIZES = (365, 546)
MONTH_ROLL_SIZES = (91, 120, 152, 182, 242, 402, 542, 722)


def dense_sales(spark, folder) -> Panel:
    """Daily order value per priority with a row, maybe without a value, for every day."""
    return windows.calendar_spine(tables.sales_panel(spark, folder))


def monthly_panel(spark, folder) -> Panel:
    """Monthly shipments per supplier, every month present, gaps filled backward."""
    spine = windows.calendar_spine(tables.monthly_shipments(spark, folder), "month")
    return windows.backward_fill(spine)


OVER_SALES = "OVER (PARTITION BY priority ORDER BY ts)"
OVER_SPARSE = "OVER (PARTITION BY supplier, flag ORDER BY ts)"


@query(
    "lag_preview",
    f"""WITH {SPARSE}
SELECT supplier, flag, {day()}, {num('sales')}, """
    + ", ".join(num(f"lag(sales, {k}) {OVER_SPARSE}", f"lag{k}") for k in (1, 2, 3, 4))
    + " FROM sparse_panel",
)
def lag_preview(spark, folder):
    return shown(combine.previous_rows(tables.sparse_panel(spark, folder), [1, 2, 3, 4]))


@query(
    "lag_features",
    f"""WITH {SALES}
SELECT priority, {day()}, {num('sales')}, """
    + ", ".join(num(f"lag(sales, {k}) {OVER_SALES}", f"sales_lag_{k}") for k in LAGS)
    + " FROM sales_panel",
)
def lag_features(spark, folder):
    return shown(windows.lag_features(tables.sales_panel(spark, folder), LAGS).frame())


def _rolling_sql(n: int, shift: int) -> str:
    frame = f"OVER (PARTITION BY supplier, flag ORDER BY ts ROWS BETWEEN {n - 1 + shift} PRECEDING AND {shift} PRECEDING)"
    name = f"roll{n}" + (f"_shift{shift}" if shift else "")
    return num(f"CASE WHEN count(sales) {frame} = {n} THEN avg(sales) {frame} END", name)


@query(
    "rolling_mean",
    f"""WITH {SPARSE}
SELECT supplier, flag, {day()}, {num('sales')}, """
    + ", ".join(_rolling_sql(n, s) for s in (0, 1) for n in (2, 3, 5)).replace("0 PRECEDING)", "CURRENT ROW)")
    + " FROM sparse_panel",
)
def rolling_mean(spark, folder):
    panel = tables.sparse_panel(spark, folder)
    return shown(
        windows.rolling_means(windows.rolling_means(panel, (2, 3, 5)), (2, 3, 5), shift=1).frame()
    )


def _triangular_sql(sizes: tuple[int, ...]) -> str:
    """The definition, pair by pair: every earlier row within reach, with its weight."""
    sums = []
    for n in sizes:
        top = f"({n + 1} / 2.0)" if n % 2 else f"({n} / 2.0)"
        place = f"({n} - gap)"
        if n % 2:
            weight = f"(least({place} + 1, {n} - {place}) / {top})"
        else:
            weight = f"((least({place}, {n} - 1 - {place}) + 0.5) / {top})"
        near = f"gap <= {n} AND v IS NOT NULL"
        sums.append(
            f"CASE WHEN count(CASE WHEN {near} THEN 1 END) >= 10 THEN "
            f"sum(CASE WHEN {near} THEN {weight} * v END) / sum(CASE WHEN {near} THEN {weight} END) END AS t{n}"
        )
    return f"""WITH {DENSE}, pairs AS (
  SELECT a.priority, a.ts, a.sales, a.rn - b.rn AS gap, b.sales AS v
  FROM dense a LEFT JOIN dense b ON b.priority = a.priority AND b.rn < a.rn AND b.rn >= a.rn - {max(sizes)}),
means AS (SELECT priority, ts, max(sales) AS sales, {', '.join(sums)} FROM pairs GROUP BY priority, ts)
SELECT priority, {day()}, {num('sales')}, {', '.join(num(f't{n}', f'sales_roll_mean_{n}', 2) for n in sizes)}
FROM means"""


@query("roll_triang", _triangular_sql(ROLL_SIZES))
def roll_triang(spark, folder):
    panel = windows.triangular_means(dense_sales(spark, folder), ROLL_SIZES)
    return _with_coarse(panel, [f"sales_roll_mean_{n}" for n in ROLL_SIZES])


@query("roll_triang_many", _triangular_sql(MONTH_ROLL_SIZES))
def roll_triang_many(spark, folder):
    """Eight window lengths from the same four running totals."""
    panel = windows.triangular_means(dense_sales(spark, folder), MONTH_ROLL_SIZES)
    return _with_coarse(panel, [f"sales_roll_mean_{n}" for n in MONTH_ROLL_SIZES])


def _with_coarse(panel: Panel, columns: list[str]):
    return shown(panel.frame().withColumns({c: rounded(F.col(c), 2) for c in columns}))


def _ewm_sql(alphas, lags, names, digits: int = 2) -> str:
    """The recurrence itself, row by row, and then offsets of its result."""
    grid = ", ".join(f"({a})" for a in alphas)
    shifted = ", ".join(
        num(f"lag(m{alpha_text(a)}, {k}) {OVER_SALES}", f'"{names(a, k)}"', digits) for a in alphas for k in lags
    )
    pivot = ", ".join(f"max(CASE WHEN alpha = {a} THEN mean END) AS m{alpha_text(a)}" for a in alphas)
    return f"""WITH RECURSIVE {DENSE}, grid(alpha) AS (VALUES {grid}),
fold AS (
  SELECT priority, rn, CAST(alpha AS DOUBLE) AS alpha, coalesce(sales, 0.0) AS num,
         CAST(CASE WHEN sales IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS den
  FROM dense CROSS JOIN grid WHERE rn = 1
  UNION ALL
  SELECT d.priority, d.rn, f.alpha, (1 - f.alpha) * f.num + coalesce(d.sales, 0.0),
         (1 - f.alpha) * f.den + CASE WHEN d.sales IS NULL THEN 0.0 ELSE 1.0 END
  FROM fold f JOIN dense d ON d.priority = f.priority AND d.rn = f.rn + 1),
means AS (
  SELECT d.priority, d.ts, d.rn, max(d.sales) AS sales, {pivot}
  FROM dense d JOIN (
    SELECT priority, rn, CAST(alpha AS VARCHAR) AS a, alpha, CASE WHEN den > 0 THEN num / den END AS mean FROM fold) f
    ON f.priority = d.priority AND f.rn = d.rn
  GROUP BY d.priority, d.ts, d.rn)
SELECT priority, {day()}, {num('sales', digits=digits)}, {shifted} FROM means"""


PREVIEW_ALPHAS = (0.99, 0.95, 0.7, 0.1)


@query("ewm", _ewm_sql(PREVIEW_ALPHAS, (1,), lambda a, k: f"ewm{alpha_text(a)}"))
def ewm(spark, folder):
    return shown(windows.ewm_means(dense_sales(spark, folder), PREVIEW_ALPHAS).frame(), 2)


@query(
    "ewm_features",
    _ewm_sql(ALPHAS, EWM_LAGS, lambda a, k: f"sales_ewm_alpha_{alpha_text(a)}_lag_{k}"),
)
def ewm_features(spark, folder):
    return shown(windows.ewm_features(dense_sales(spark, folder), ALPHAS, EWM_LAGS).frame(), 2)


@query(
    "head_per_group",
    f"""WITH {SPARSE}, placed AS (SELECT *, row_number() {OVER_SPARSE} AS rn FROM sparse_panel)
SELECT supplier, flag, {day()}, {num('sales')} FROM placed WHERE rn <= 5""",
)
def head_per_group(spark, folder):
    return shown(windows.first_rows(tables.sparse_panel(spark, folder), 5).frame())


def _parts_sql(model: str) -> str:
    less, off = ("-", "-") if model == "additive" else ("/", "/")
    residual = "y - trend - seasonal" if model == "additive" else "y / (trend * seasonal)"
    window = "OVER (PARTITION BY supplier ORDER BY rn ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)"
    ends = "OVER (PARTITION BY supplier ORDER BY rn)"
    return f"""WITH {MONTHLY}, trends AS (
  SELECT *, CASE WHEN rn > 6 AND rn <= n - 6 THEN
    (sum(y) {window} - 0.5 * lag(y, 6) {ends} - 0.5 * lead(y, 6) {ends}) / 12 END AS trend
  FROM monthly),
phases AS (
  SELECT supplier, (rn - 1) % 12 AS phase, avg(y {less} trend) AS m FROM trends GROUP BY 1, 2),
centred AS (
  SELECT supplier, phase, m {off} avg(m) OVER (PARTITION BY supplier) AS seasonal FROM phases),
parts AS (
  SELECT t.supplier, t.ts, t.y, t.trend, c.seasonal, {residual} AS residual
  FROM trends t JOIN centred c ON c.supplier = t.supplier AND c.phase = (t.rn - 1) % 12)"""


@query(
    "decompose",
    _parts_sql("additive")
    + "".join(
        f"\n{'UNION ALL ' if i else ''}SELECT supplier, {day()}, '{c}' AS component, {num(e, 'value', 6)} FROM parts"
        for i, (c, e) in enumerate(
            (("observed", "y"), ("trend", "trend"), ("seasonal", "seasonal"), ("residual", "residual"))
        )
    ),
)
def decompose_query(spark, folder):
    parts = decompose(monthly_panel(spark, folder))
    return shown(components_long(parts, ["supplier"], "ts", "sales"), 6)


@query(
    "decompose_mul",
    _parts_sql("multiplicative")
    + f"\nSELECT supplier, {day()}, {num('y', 'sales')}, {num('trend')}, {num('seasonal')}, {num('residual')} FROM parts",
)
def decompose_mul(spark, folder):
    return shown(decompose(monthly_panel(spark, folder), model="multiplicative"))


@query(
    "decompose_summary",
    _parts_sql("additive")
    + f"\nSELECT supplier, {num('avg(seasonal)', 'seasonal_mean', 7)}, {num('avg(residual)', 'residual_mean', 7)} FROM parts GROUP BY supplier",
)
def decompose_summary(spark, folder):
    """Seasonal and residual means; the former differ from zero by the uneven last year only."""
    return shown(component_means(decompose(monthly_panel(spark, folder)), ["supplier"]), 7)


@query(
    "noise",
    f"""WITH {SPARSE}, lagged AS (SELECT flag, lag(sales, 1) {OVER_SPARSE} AS v FROM sparse_panel)
SELECT flag, count(v) AS n, true AS centred, true AS spread FROM lagged GROUP BY flag""",
)
def noise(spark, folder):
    """Random noise on lags: as many draws as rows, around zero, with the set spread."""
    panel = windows.lag_features(tables.sparse_panel(spark, folder), [1])
    plain = panel.df.withColumnRenamed("sales_lag_1", "plain")
    noisy = windows.lag_features(panel.with_df(plain), [1], noise_sd=1.6, seed=11)
    added = F.col("sales_lag_1") - F.col("plain")
    return (
        noisy.frame()
        .groupBy("flag")
        .agg(
            F.count(added).alias("n"),
            (F.abs(F.avg(added)) < 0.2).alias("centred"),
            F.stddev_samp(added).between(1.4, 1.8).alias("spread"),
        )
    )


EVENTS = "events_panel AS (SELECT event_type, ts, event_id, value FROM events)"
OVER_EVENTS = "OVER (PARTITION BY event_type ORDER BY ts, event_id)"
OVER_PLACED = "OVER (PARTITION BY p.event_type ORDER BY p.rn)"
SEGMENT_ROWS = 1000


def _events(spark, folder) -> Panel:
    return Panel(tables.hourly_events(spark, folder), ("event_type",), "ts", "value")


@query(
    "segmented_features",
    f"""WITH {EVENTS}, placed AS (SELECT *, row_number() {OVER_EVENTS} AS rn FROM events_panel),
weighted AS (
  SELECT a.event_id, sum((10 - abs(a.rn - b.rn - 10)) * b.value) / sum(10 - abs(a.rn - b.rn - 10)) AS mean, count(*) AS known
  FROM placed a JOIN placed b
    ON b.event_type = a.event_type AND b.rn < a.rn AND b.rn >= a.rn - 19
  GROUP BY a.event_id)
SELECT p.event_type, p.event_id, {num('p.value', 'value', 6)},
  {num(f'lag(p.value, 7) {OVER_PLACED}', 'value_lag_7', 6)}, {num(f'lag(p.value, 91) {OVER_PLACED}', 'value_lag_91', 6)},
  {num(f'CASE WHEN p.rn > 3 THEN avg(p.value) {OVER_PLACED.replace(')', ' ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)')} END', 'roll3_shift1', 6)},
  {num('CASE WHEN w.known >= 10 THEN w.mean END', 'value_roll_mean_19', 6)}
FROM placed p LEFT JOIN weighted w ON w.event_id = p.event_id""",
)
def segmented_features(spark, folder):
    """Lags and means over raw events: series of timestamps, cut into chunks that overlap."""

    def build(panel: Panel) -> Panel:
        panel = windows.lag_features(panel, (7, 91))
        panel = windows.rolling_means(panel, (3,), shift=1)
        return windows.triangular_means(panel, (19,))

    done = over_segments(_events(spark, folder), build, tie_break=("event_id",), rows=SEGMENT_ROWS)
    return shown(done.drop("ts"), 6)


@query(
    "segmented_bfill",
    f"""SELECT event_type, event_id, {num('value')},
  {num('''first_value(CASE WHEN value >= 5 THEN value END IGNORE NULLS) OVER (
    PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)''', 'next_large')}
FROM events""",
)
def segmented_bfill(spark, folder):
    """The next value of at least 5 after each event, over series of any length."""
    df = tables.hourly_events(spark, folder)
    large = df.withColumn("large", F.when(F.col("value") >= 5, F.col("value")))
    filled = backward_fill_long(Panel(large, ("event_type",), "ts", "large"), "next_large", ("event_id",))
    return shown(filled.select("event_type", "event_id", "value", "next_large"))


PANEL_LAGS = (7, 14, 28, 91, 98, 105, 112, 119, 126, 182)
PANEL_ROLLS = (28, 91, 182)
PANEL_EWM_LAGS = (91, 112, 180)


def _all_features_sql() -> str:
    over = "OVER (PARTITION BY supplier, flag ORDER BY rn)"
    lags = ", ".join(num(f"p.l{k}", f"sales_lag_{k}") for k in PANEL_LAGS)
    weight = {
        n: f"(least({n} - gap, gap - 1) + 0.5)" if n % 2 == 0 else f"(least({n} - gap, gap - 1) + 1)"
        for n in PANEL_ROLLS
    }
    sums = ", ".join(
        f"CASE WHEN count(CASE WHEN gap <= {n} THEN 1 END) >= 10 THEN sum(CASE WHEN gap <= {n} THEN {w} * v END) "
        f"/ sum(CASE WHEN gap <= {n} THEN {w} END) END AS t{n}"
        for n, w in weight.items()
    )
    ewms = ", ".join(
        f"sum(pow(1 - {a}, gap - 1) * v) / sum(pow(1 - {a}, gap - 1)) AS e{alpha_text(a)}" for a in ALPHAS
    )
    # The pairs hold rows before the current one, so their exponential mean is the one a row back.
    shifted = ", ".join(
        num(f"lag(e{alpha_text(a)}, {k - 1}) {over}", f'"sales_ewm_alpha_{alpha_text(a)}_lag_{k}"')
        for a in ALPHAS
        for k in PANEL_EWM_LAGS
    )
    raw_lags = ", ".join(f"lag(sales, {k}) {OVER_SPARSE} AS l{k}" for k in PANEL_LAGS)
    return f"""WITH {SPARSE}, p AS (
  SELECT *, row_number() {OVER_SPARSE} AS rn, {raw_lags} FROM sparse_panel),
pairs AS (
  SELECT a.supplier, a.flag, a.rn, a.rn - b.rn AS gap, b.sales AS v
  FROM p a JOIN p b ON b.supplier = a.supplier AND b.flag = a.flag AND b.rn < a.rn),
means AS (SELECT supplier, flag, rn, {sums}, {ewms} FROM pairs GROUP BY supplier, flag, rn),
joined AS (SELECT p.*, m.* EXCLUDE (supplier, flag, rn) FROM p LEFT JOIN means m
  ON m.supplier = p.supplier AND m.flag = p.flag AND m.rn = p.rn)
SELECT supplier, flag, {day()}, {num('sales')}, {lags.replace('p.l', 'l')},
  {', '.join(num(f't{n}', f'sales_roll_mean_{n}', 3) for n in PANEL_ROLLS)}, {shifted}
FROM joined"""


@query("panel_features", _all_features_sql())
def all_features(spark, folder):
    """Lags, triangular and exponential means of many sparse series in one pass over them."""
    sparse = tables.sparse_panel(spark, folder)
    # The exponential means take the most steps, and every step copies its rows: they go first, while rows are short.
    panel = windows.ewm_features(sparse, ALPHAS, PANEL_EWM_LAGS)
    means = [c for c in panel.df.columns if c not in sparse.df.columns]
    panel = windows.triangular_means(panel, PANEL_ROLLS)
    panel = windows.lag_features(panel, PANEL_LAGS)
    rolls = [f"sales_roll_mean_{n}" for n in PANEL_ROLLS]
    lags = [c for c in panel.df.columns if c not in (*sparse.df.columns, *means, *rolls)]
    coarse = rounded_in_batches(3)
    columns = panel.frame().select(*sparse.df.columns, *lags, *rolls, *means)
    return shown(columns.withColumns({c: coarse(F.col(c)) for c in rolls}))
