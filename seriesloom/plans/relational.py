"""Scans, filters, joins, unions, sorts and summaries over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    from_log,
    mean_absolute_error,
    parse_date,
    replace_in_names,
    smape,
    to_log,
)
from ..operators import categories, combine, summarize, windows
from ..sources import tables
from .registry import DENSE, DIGITS, MERCHANT, SALES, SPARSE, day, num, query, shown


@query(
    "parse_dates",
    f"SELECT o_orderkey, {day('o_orderdate', 'parsed')} FROM orders",
)
def parse_dates(spark, folder):
    """Dates read back from text written in two formats."""
    orders = tables.table(spark, folder, "orders")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MMM dd, yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return shown(
        orders.select("o_orderkey", parse_date(text, "yyyy-MM-dd", "MMM dd, yyyy").alias("parsed"))
    )


@query(
    "date_features",
    f"""WITH {SALES}
SELECT priority, {day()}, {num('sales')},
  CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day_of_month,
  CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
  CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(year(ts) AS INTEGER) AS year,
  CAST((isodow(ts) - 1) // 4 AS INTEGER) AS is_wknd,
  CAST(day(ts) = 1 AS INTEGER) AS is_month_start,
  CAST(ts = last_day(ts) AS INTEGER) AS is_month_end
FROM sales_panel""",
)
def date_features(spark, folder):
    return shown(combine.add_calendar(tables.sales_panel(spark, folder).df, "ts"))


@query(
    "time_split",
    f"""WITH {SALES}
SELECT priority, {day()}, {num('sales')},
  CASE WHEN ts < DATE '2000-01-01' THEN 'train' ELSE 'valid' END AS part
FROM sales_panel WHERE ts < DATE '2000-04-01'""",
)
def time_split(spark, folder):
    panel = tables.sales_panel(spark, folder)
    return shown(combine.tag_split(panel.df, "ts", "2000-01-01", "2000-04-01"))


@query(
    "train_test_by_null",
    f"""WITH {DENSE}
SELECT priority, {day()}, {num('sales')},
  CASE WHEN sales IS NULL THEN 'test' ELSE 'train' END AS part
FROM dense""",
)
def train_test_by_null(spark, folder):
    """Days with a measured value train; days without are to be predicted."""
    dense = windows.calendar_spine(tables.sales_panel(spark, folder)).df
    train, test = combine.split_by_target(dense, "sales")
    return shown(
        combine.stack(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))
    )


@query(
    "holdout_position",
    f"""WITH {SALES}
SELECT priority, {day()}, {num('sales')},
  CASE WHEN row_number() OVER (PARTITION BY priority ORDER BY ts) <= 120 THEN 'train' ELSE 'test' END AS part
FROM sales_panel""",
)
def holdout_position(spark, folder):
    return shown(combine.split_by_position(tables.sales_panel(spark, folder), 120))


@query(
    "holdout_label",
    f"""WITH {SALES}
SELECT priority, {day()}, {num('sales')}, 'train' AS part FROM sales_panel WHERE ts <= DATE '1999-12-01'
UNION ALL
SELECT priority, {day()}, {num('sales')}, 'test' AS part FROM sales_panel WHERE ts >= DATE '2000-01-01'""",
)
def holdout_label(spark, folder):
    df = tables.sales_panel(spark, folder).df
    train = combine.through(df, "ts", last="1999-12-01").withColumn("part", F.lit("train"))
    test = combine.through(df, "ts", first="2000-01-01").withColumn("part", F.lit("test"))
    return shown(combine.stack(train, test))


RATE_SQL = f"""WITH {MERCHANT}, rate AS (
  SELECT CAST(l_shipdate AS DATE) AS ts, avg(l_discount) AS price FROM lineitem GROUP BY 1)
SELECT merchant, {day('coalesce(m.ts, r.ts)', 'transaction_date')}, transactions, {num('paid')}, {num('price')}
FROM merchant_panel m FULL JOIN rate r ON m.ts = r.ts"""


@query("rate_join", RATE_SQL)
def rate_join(spark, folder):
    """A per-date covariate joined to every series; unmatched dates of both sides stay."""
    merchants = tables.merchant_panel(spark, folder).df.withColumnRenamed("ts", "transaction_date")
    rate = replace_in_names(tables.daily_rate(spark, folder), "ship_date", "transaction_date")
    return shown(
        combine.join_covariate(merchants, rate, "transaction_date", drop=("low", "high")).select(
            "merchant", "transaction_date", "transactions", "paid", "price"
        )
    )


NAIVE = f"""{SPARSE}, naive AS (
  SELECT supplier, flag, ts, sales,
         lag(sales, 7) OVER (PARTITION BY supplier, flag ORDER BY ts) AS prediction
  FROM sparse_panel)"""


def _naive(spark, folder) -> DataFrame:
    """The value seven rows earlier as the forecast of each row."""
    panel = windows.lag_features(tables.sparse_panel(spark, folder), [7])
    return panel.frame().withColumnRenamed("sales_lag_7", "prediction")


@query(
    "forecast_vs_actual",
    f"""WITH {NAIVE}
SELECT supplier, flag, {day()}, {num('sales', 'actual')}, {num('prediction')},
       {num('abs(sales - prediction)', 'error')}
FROM naive WHERE prediction IS NOT NULL""",
)
def forecast_vs_actual(spark, folder):
    panel = tables.sparse_panel(spark, folder)
    predicted = _naive(spark, folder).where(F.col("prediction").isNotNull())
    aligned = combine.align(
        predicted.select("supplier", "flag", "ts", "prediction"),
        panel.df.withColumnRenamed("sales", "actual"),
        ["supplier", "flag", "ts"],
    )
    return shown(
        aligned.withColumn("error", F.abs(F.col("actual") - F.col("prediction"))).select(
            "supplier", "flag", "ts", "actual", "prediction", "error"
        )
    )


@query(
    "mae",
    f"""WITH {NAIVE}
SELECT supplier, flag, {num('avg(abs(sales - prediction))', 'mae')}
FROM naive GROUP BY supplier, flag""",
)
def mae(spark, folder):
    return shown(
        _naive(spark, folder)
        .groupBy("supplier", "flag")
        .agg(mean_absolute_error(F.col("sales"), F.col("prediction")).alias("mae"))
    )


SMAPE_TERMS = """CASE WHEN p = 0 AND t = 0 THEN 0.0 ELSE abs(p - t) / (abs(p) + abs(t)) END"""


@query(
    "smape",
    f"""WITH {NAIVE}, pairs AS (
  SELECT supplier, flag, prediction AS p, sales AS t FROM naive WHERE prediction IS NOT NULL)
SELECT supplier, flag, {num(f'200.0 * sum({SMAPE_TERMS}) / count(*)', 'smape')}
FROM pairs GROUP BY supplier, flag""",
)
def smape_query(spark, folder):
    scored = _naive(spark, folder).where(F.col("prediction").isNotNull())
    return shown(
        scored.groupBy("supplier", "flag").agg(smape(F.col("prediction"), F.col("sales")).alias("smape"))
    )


@query(
    "smape_log",
    f"""WITH {NAIVE}, pairs AS (
  SELECT flag, exp(ln(1 + prediction)) - 1 AS p, exp(ln(1 + sales)) - 1 AS t
  FROM naive WHERE prediction IS NOT NULL)
SELECT flag, {num(f'200.0 * sum({SMAPE_TERMS}) / count(*)', 'smape')} FROM pairs GROUP BY flag""",
)
def smape_log(spark, folder):
    """The same score for a model that works on the log scale."""
    logs = _naive(spark, folder).withColumns(
        {"prediction": to_log(F.col("prediction")), "sales": to_log(F.col("sales"))}
    )
    return shown(
        logs.where(F.col("prediction").isNotNull())
        .groupBy("flag")
        .agg(smape(F.col("prediction"), F.col("sales"), log_scale=True).alias("smape"))
    )


@query(
    "log_target",
    f"""WITH {DENSE}
SELECT priority, {day()}, {num('ln(1 + sales)', 'sales_log')}, {num('sales', 'sales_back')} FROM dense""",
)
def log_target(spark, folder):
    dense = windows.calendar_spine(tables.sales_panel(spark, folder)).df
    logged = dense.withColumn("sales_log", to_log(F.col("sales")))
    return shown(
        logged.select("priority", "ts", "sales_log", from_log(F.col("sales_log")).alias("sales_back"))
    )


@query(
    "submission",
    f"""WITH {SALES}, lagged AS (
  SELECT priority, ts, lag(sales, 91) OVER (PARTITION BY priority ORDER BY ts) AS p FROM sales_panel)
SELECT CAST((year(ts) * 10000 + month(ts) * 100 + day(ts)) * 10 + CAST(priority[1] AS INTEGER) AS BIGINT) AS id,
       {num('p', 'sales')}
FROM lagged WHERE p IS NOT NULL""",
)
def submission(spark, folder):
    """Integer id and back-transformed prediction of a lag model."""
    panel = windows.lag_features(tables.sales_panel(spark, folder), [91])
    scored = panel.frame().where(F.col("sales_lag_91").isNotNull())
    scored = scored.withColumns(
        {
            "id": F.date_format("ts", "yyyyMMdd").cast("long") * 10
            + F.substring("priority", 1, 1).cast("long"),
            "prediction": to_log(F.col("sales_lag_91")),
        }
    )
    return shown(combine.submission(scored, "id", from_log(F.col("prediction")), "sales"))


@query(
    "union_by_name",
    f"""WITH {SALES}
SELECT {day()}, priority, {num('sales')}, CAST(NULL AS INTEGER) AS id
FROM sales_panel WHERE ts < DATE '2000-01-01'
UNION ALL
SELECT {day()}, priority, CAST(NULL AS DOUBLE) AS sales, CAST(year(ts) AS INTEGER) AS id
FROM sales_panel WHERE ts >= DATE '2000-01-01'""",
)
def union_by_name(spark, folder):
    """Stack a labelled table and one that has an id instead of the target."""
    df = tables.sales_panel(spark, folder).df
    train = combine.between(df, "ts", end="2000-01-01").select("ts", "priority", "sales")
    test = combine.between(df, "ts", start="2000-01-01").select(F.year("ts").alias("id"), "ts", "priority")
    return shown(combine.stack(train, test))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "one_hot",
    f"""WITH {RATE_SQL.removeprefix('WITH ').replace('SELECT merchant,', ', joined AS (SELECT merchant,')})
SELECT transaction_date, transactions, """
    + ", ".join(f"CAST(coalesce(merchant = '{p}', false) AS INTEGER) AS \"merchant_{p}\"" for p in PRIORITIES)
    + ", "
    + ", ".join(
        f"CAST(isodow(CAST(transaction_date AS DATE)) = {d + 1} AS INTEGER) AS day_of_week_{d}" for d in range(7)
    )
    + " FROM joined",
)
def one_hot(spark, folder):
    """Indicators of the series and the weekday; rows without a series get zeros."""
    joined = rate_join(spark, folder).select(
        "transaction_date",
        "merchant",
        "transactions",
        F.weekday(F.col("transaction_date").cast("date")).alias("day_of_week"),
    )
    return combine.one_hot(joined, ["merchant", "day_of_week"])


CODED = ("l_partkey", "l_shipdate")


@query(
    "category_codes",
    "WITH "
    + ", ".join(f"{c}_codes AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM lineitem WHERE {c} IS NOT NULL))" for c in CODED)
    + f"""
SELECT l_orderkey, {', '.join(f'{c}_codes.code AS {c}__code' for c in CODED)}
FROM lineitem {' '.join(f'LEFT JOIN {c}_codes USING ({c})' for c in CODED)}""",
)
def category_codes(spark, folder):
    """Numbers of every part and every date, as many as there are."""
    rows = tables.table(spark, folder, "lineitem").select("l_orderkey", *CODED)
    return categories.coded(rows, CODED).drop(*CODED)


@query(
    "forecast_overlay",
    f"""WITH {SALES}, marked AS (
  SELECT *, row_number() OVER (PARTITION BY priority ORDER BY ts) AS rn,
         lag(sales, 91) OVER (PARTITION BY priority ORDER BY ts) AS p
  FROM sales_panel)
SELECT priority, {day()}, {num('sales')}, CASE WHEN rn <= 120 THEN 'TRAIN' ELSE 'TEST' END AS part FROM marked
UNION ALL
SELECT priority, {day()}, {num('p', 'sales')}, 'PREDICTION' AS part FROM marked WHERE rn > 120""",
)
def forecast_overlay(spark, folder):
    """Training, test and predicted values in one labelled table."""
    panel = windows.lag_features(tables.sales_panel(spark, folder), [91])
    marked = combine.split_by_position(panel, 120)
    return shown(combine.overlay_marked(marked, ["priority", "ts"], "sales", "sales_lag_91"))


@query(
    "sorted_panel",
    f"""WITH {SPARSE}
SELECT supplier, flag, {day()}, {num('sales')} FROM sparse_panel ORDER BY supplier, flag, ts""",
)
def sorted_panel(spark, folder):
    return shown(tables.sparse_panel(spark, folder).df.orderBy("supplier", "flag", "ts"))


@query(
    "head_tail",
    f"""WITH {SPARSE}, placed AS (
  SELECT *, row_number() OVER (ORDER BY supplier, flag, ts) AS a,
         row_number() OVER (ORDER BY supplier DESC, flag DESC, ts DESC) AS z
  FROM sparse_panel)
SELECT supplier, flag, {day()}, {num('sales')}, 'head' AS section, CAST(a AS INTEGER) AS place FROM placed WHERE a <= 5
UNION ALL
SELECT supplier, flag, {day()}, {num('sales')}, 'tail' AS section, CAST(z AS INTEGER) AS place FROM placed WHERE z <= 5""",
)
def head_tail(spark, folder):
    """First and last rows of the sorted table."""
    df = tables.sparse_panel(spark, folder).df
    order = ["supplier", "flag", "ts"]
    parts = {"head": summarize.head_rows(df, order), "tail": summarize.tail_rows(df, order)}
    return shown(
        combine.stack(*[p.withColumn("section", F.lit(s)) for s, p in parts.items()]).withColumnRenamed(
            "_place", "place"
        )
    )


# --- aggregates ---------------------------------------------------------------


@query(
    "date_range",
    f"SELECT {day('min(o_orderdate)', 'first_day')}, {day('max(o_orderdate)', 'last_day')} FROM orders",
)
def date_range(spark, folder):
    orders = tables.table(spark, folder, "orders")
    days = F.col("o_orderdate").cast("date")
    return shown(orders.agg(F.min(days).alias("first_day"), F.max(days).alias("last_day")))


@query(
    "totals",
    f"""WITH {SPARSE}
SELECT count(DISTINCT supplier) AS n_suppliers, count(DISTINCT flag) AS n_flags, {num('sum(sales)', 'total_sales', 2)}
FROM sparse_panel""",
)
def totals(spark, folder):
    df = tables.sparse_panel(spark, folder).df
    return shown(
        df.agg(
            F.count_distinct("supplier").alias("n_suppliers"),
            F.count_distinct("flag").alias("n_flags"),
            summarize.total("sales").alias("total_sales"),
        ),
        2,
    )


@query(
    "distinct_per_group",
    "SELECT l_returnflag AS flag, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1",
)
def distinct_per_group(spark, folder):
    rows = tables.table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_suppkey")
    return (
        summarize.known_keys(rows, ["flag"])
        .groupBy("flag")
        .agg(F.count_distinct("l_suppkey").alias("n_suppliers"))
    )


@query(
    "group_sum",
    f"SELECT l_suppkey AS supplier, l_returnflag AS flag, {num('sum(l_quantity)', 'sales_sum')} FROM lineitem GROUP BY 1, 2",
)
def group_sum(spark, folder):
    rows = tables.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("sales")
    )
    return shown(summarize.group_statistics(rows, ["supplier", "flag"], {"sales": ["sum"]}))


def _stats_sql(y: str, which: str, digits: int = DIGITS) -> str:
    known = {"sum": f"sum({y})", "mean": f"avg({y})", "median": f"median({y})", "std": f"stddev_samp({y})"}
    return ", ".join(num(known[s], f"{y}_{s}", digits) for s in which.split())


@query(
    "group_stats",
    f"""WITH {SPARSE}
SELECT supplier, flag, {_stats_sql('sales', 'sum mean median std')} FROM sparse_panel GROUP BY 1, 2""",
)
def group_stats(spark, folder):
    df = tables.sparse_panel(spark, folder).df
    return shown(
        summarize.group_statistics(df, ["supplier", "flag"], {"sales": ["sum", "mean", "median", "std"]})
    )


@query(
    "group_two_measures",
    f"""WITH {MERCHANT}
SELECT {day()}, CAST(sum(transactions) AS DOUBLE) AS transactions_sum, {num('avg(transactions)', 'transactions_mean')},
       {num('sum(paid)', 'paid_sum')}, {num('avg(paid)', 'paid_mean')}
FROM merchant_panel GROUP BY ts""",
)
def group_two_measures(spark, folder):
    df = tables.merchant_panel(spark, folder).df
    stats = summarize.group_statistics(
        df, ["ts"], {"transactions": ["sum", "mean"], "paid": ["sum", "mean"]}
    )
    return shown(stats)


@query(
    "calendar_stats",
    f"""WITH {SPARSE}
SELECT supplier, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       {_stats_sql('sales', 'sum mean median std')}
FROM sparse_panel GROUP BY 1, 2, 3""",
)
def calendar_stats(spark, folder):
    df = combine.add_calendar(tables.sparse_panel(spark, folder).df, "ts")
    return shown(
        summarize.group_statistics(
            df, ["supplier", "year", "month"], {"sales": ["sum", "mean", "median", "std"]}
        )
    )


@query(
    "value_group_stats",
    f"""WITH {MERCHANT}
SELECT merchant, transactions, CAST(month(ts) AS INTEGER) AS month, {_stats_sql('paid', 'sum mean median std')}
FROM merchant_panel GROUP BY 1, 2, 3""",
)
def value_group_stats(spark, folder):
    df = combine.add_calendar(tables.merchant_panel(spark, folder).df, "ts")
    return shown(
        summarize.group_statistics(
            df, ["merchant", "transactions", "month"], {"paid": ["sum", "mean", "median", "std"]}
        )
    )


@query(
    "null_counts",
    f"""WITH {RATE_SQL.removeprefix('WITH ').replace('SELECT merchant,', ', joined AS (SELECT merchant,')})
"""
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM joined"
        for c in ("merchant", "transaction_date", "transactions", "paid", "price")
    ),
)
def null_counts(spark, folder):
    return summarize.null_counts(rate_join(spark, folder))


def _quantiles_sql(column: str, source: str) -> str:
    cells = ", ".join(
        num(f"quantile_cont(CAST({column} AS DOUBLE), {p:g})", f"\"{summarize.quantile_label(p)}\"")
        for p in summarize.PROFILE_PROBS
    )
    return f"SELECT '{column}' AS column_name, {cells} FROM {source}"


LINE_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)


@query("quantile_table", "\nUNION ALL\n".join(_quantiles_sql(c, "lineitem") for c in LINE_NUMBERS))
def quantile_table(spark, folder):
    return shown(summarize.quantile_table(tables.table(spark, folder, "lineitem")))


@query(
    "describe",
    f"SELECT 'count' AS stat, {num('count(l_extendedprice)', 'value')} FROM lineitem\n"
    + "".join(
        f"UNION ALL SELECT '{s}', {num(f'{f}(l_extendedprice)', 'value')} FROM lineitem\n"
        for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    )
    + "".join(
        f"UNION ALL SELECT '{p * 100:.0f}%', {num(f'quantile_cont(l_extendedprice, {p:g})', 'value')} FROM lineitem\n"
        for p in sorted({*summarize.DESCRIBE_PROBS, 0.5})
    ),
)
def describe(spark, folder):
    return shown(summarize.describe_column(tables.table(spark, folder, "lineitem"), "l_extendedprice"))


def _profile_sql() -> str:
    columns = {"merchant": "string", "ts": "date", "transactions": "bigint", "paid": "double"}
    numeric = ("transactions", "paid")
    parts = [
        "SELECT 'shape' AS section, CAST(NULL AS VARCHAR) AS column_name, 'rows' AS stat, "
        "CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM merchant_panel",
        f"SELECT 'shape', NULL, 'columns', {float(len(columns))}, NULL",
    ]
    for c, t in columns.items():
        parts.append(f"SELECT 'types', '{c}', 'dtype', NULL, '{t}'")
        parts.append(f"SELECT 'missing', '{c}', 'n_missing', CAST(count(*) - count({c}) AS DOUBLE), NULL FROM merchant_panel")
        parts.append(f"SELECT 'missing', '{c}', 'n_known', CAST(count({c}) AS DOUBLE), NULL FROM merchant_panel")
        value = num(c, "value") if c in numeric else "NULL"
        text = "NULL" if c in numeric else f"CAST({c} AS VARCHAR)"
        for section, place in (("head", "a"), ("tail", "z")):
            parts.append(
                f"SELECT '{section}', '{c}', 'row ' || {place}, {value}, {text} FROM placed WHERE {place} <= 5"
            )
        if c in numeric:
            for p in summarize.PROFILE_PROBS:
                quantile = num(f"quantile_cont(CAST({c} AS DOUBLE), {p:g})", "value")
                parts.append(f"SELECT 'quantiles', '{c}', '{float(p)}', {quantile}, NULL FROM merchant_panel")
    return (
        f"WITH {MERCHANT}, placed AS (SELECT *, row_number() OVER (ORDER BY merchant, ts) AS a, "
        "row_number() OVER (ORDER BY merchant DESC, ts DESC) AS z FROM merchant_panel)\n"
        + "\nUNION ALL\n".join(parts)
    )


@query("profile", _profile_sql())
def profile(spark, folder):
    return shown(summarize.profile(tables.merchant_panel(spark, folder).df, ["merchant", "ts"]))


@query(
    "box_stats",
    f"""WITH {SPARSE}, boxes AS (
  SELECT CAST(month(ts) AS INTEGER) AS month, quantile_cont(sales, 0.25) AS q1, median(sales) AS med,
         quantile_cont(sales, 0.75) AS q3
  FROM sparse_panel GROUP BY 1),
marked AS (
  SELECT b.*, s.sales, s.sales BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM sparse_panel s JOIN boxes b ON b.month = month(s.ts))
SELECT month, count(*) AS n, {num('max(q1)', 'q1')}, {num('max(med)', 'median')}, {num('max(q3)', 'q3')},
       {num('min(CASE WHEN inside THEN sales END)', 'whisker_low')},
       {num('max(CASE WHEN inside THEN sales END)', 'whisker_high')},
       CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM marked GROUP BY month""",
)
def box_stats(spark, folder):
    df = tables.sparse_panel(spark, folder).df.withColumn("month", F.month("ts"))
    return shown(summarize.box_statistics(df, ["month"], "sales"))


def _classes_sql() -> str:
    columns = {
        "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"},
        "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
        "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_extendedprice": "double", "l_tax": "double", "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string", "l_quantity": "double", "l_discount": "double", "l_shipdate": "timestamp"},
    }
    parts = []
    for name, fields in columns.items():
        for c, t in fields.items():
            if t == "string":
                label = f"CASE WHEN count(DISTINCT {c}) > 20 THEN 'cardinal' ELSE 'categorical' END"
            else:
                label = f"CASE WHEN count(DISTINCT {c}) < 10 THEN 'categorical' ELSE 'numeric' END"
            parts.append(
                f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{t}' AS dtype, {label} AS class FROM {name}"
            )
    return "\nUNION ALL\n".join(parts)


@query("column_classes", _classes_sql())
def column_classes(spark, folder):
    """Categorical, numeric and cardinal columns of three tables."""
    lines = tables.table(spark, folder, "lineitem")
    lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    found = {
        "part": summarize.classify_columns(tables.table(spark, folder, "part")),
        "customer": summarize.classify_columns(tables.table(spark, folder, "customer")),
        "lineitem": summarize.classify_columns(lines),
    }
    return reduce(
        DataFrame.unionByName, [df.select(F.lit(n).alias("table_name"), "*") for n, df in found.items()]
    )


@query(
    "resample_month",
    """WITH means AS (
  SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS ts, avg(l_quantity) AS sales
  FROM lineitem GROUP BY 1, 2),
spine AS (
  SELECT supplier, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS DATE) AS ts
  FROM means GROUP BY supplier)
"""
    + f"SELECT s.supplier, {day('s.ts', 'ts')}, {num('m.sales', 'sales')} FROM spine s LEFT JOIN means m ON m.supplier = s.supplier AND m.ts = s.ts",
)
def resample_month(spark, folder):
    """Monthly mean per supplier with every month present."""
    from ..panel import Panel

    panel = Panel.aggregate(
        tables.table(spark, folder, "lineitem"),
        {"supplier": "l_suppkey"},
        "l_shipdate",
        {"sales": F.avg("l_quantity")},
        period="month",
    )
    return shown(windows.calendar_spine(panel, "month").df)


HOURLY = """hours AS (
  SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
spine AS (
  SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
  FROM hours GROUP BY event_type),
dense_hours AS (
  SELECT s.event_type, s.ts, h.value
  FROM spine s LEFT JOIN hours h ON h.event_type = s.event_type AND h.ts = s.ts)"""


@query(
    "bfill",
    f"""WITH {HOURLY}
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {num('value')},
  {num('''coalesce(value, first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))''', 'filled')}
FROM dense_hours""",
)
def bfill(spark, folder):
    """Hourly means with empty hours filled from the next known one."""
    from ..panel import Panel

    panel = Panel.aggregate(
        tables.hourly_events(spark, folder), ["event_type"], "ts", {"value": F.avg("value")}, period="hour"
    )
    return shown(windows.backward_fill(windows.calendar_spine(panel, "hour"), into="filled").frame())


@query(
    "yearly_series",
    f"""WITH {MERCHANT}
SELECT merchant, CAST(year(ts) AS INTEGER) AS year, {day()}, CAST(sum(transactions) AS BIGINT) AS transactions, {num('sum(paid)', 'paid')}
FROM merchant_panel GROUP BY 1, 2, ts""",
)
def yearly_series(spark, folder):
    """Both measures by day within each year of each series: the data behind line figures."""
    df = tables.merchant_panel(spark, folder).df
    return shown(
        df.groupBy("merchant", F.year("ts").alias("year"), "ts").agg(
            F.sum("transactions").alias("transactions"), F.sum("paid").alias("paid")
        )
    )


