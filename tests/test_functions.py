import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesloom.functions import (
    alpha_text,
    calendar_parts,
    ewm_name,
    from_log,
    lag_name,
    noise,
    parse_date,
    replace_in_names,
    roll_name,
    smape,
    to_log,
)


def test_calendar_parts_of_known_days(spark):
    days = ["2020-01-03", "2021-01-01", "2020-12-31", "2020-02-29"]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.to_date("d"))
    rows = {str(r["d"]): r for r in df.withColumns(calendar_parts(F.col("d"))).collect()}
    assert (rows["2020-01-03"]["day_of_week"], rows["2020-01-03"]["is_wknd"]) == (4, 1)
    assert rows["2021-01-01"]["week_of_year"] == 53
    assert rows["2021-01-01"]["is_month_start"] == 1
    assert rows["2020-12-31"]["day_of_year"] == 366
    assert rows["2020-02-29"]["is_month_end"] == 1
    saturday = df.withColumns(calendar_parts(F.col("d"), first_weekend_day=5)).collect()
    assert {str(r["d"]): r["is_wknd"] for r in saturday}["2020-01-03"] == 0


def test_parse_date_takes_the_first_format_that_fits(spark):
    df = spark.createDataFrame([("1949-01",), ("Sep 15, 2023",), ("?",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_date(F.col("t"), "yyyy-MM", "MMM dd, yyyy")).collect()]
    assert got == [dt.date(1949, 1, 1), dt.date(2023, 9, 15), None, None]


def test_names():
    assert alpha_text(0.95) == "095"
    assert lag_name("sales", 91) == "sales_lag_91"
    assert roll_name("sales", 365) == "sales_roll_mean_365"
    assert ewm_name("sales", 0.5, 91) == "sales_ewm_alpha_05_lag_91"


def test_replace_in_names(spark):
    df = spark.createDataFrame([(1, 2)], "Date int, Price int")
    assert replace_in_names(df, "Date", "transaction_date").columns == ["transaction_date", "Price"]
    with pytest.raises(ValueError):
        replace_in_names(spark.createDataFrame([(1, 2)], "ab int, b int"), "a", "")


def scores(spark, rows, **kw):
    df = spark.createDataFrame(rows, "p double, t double")
    return df.agg(smape(F.col("p"), F.col("t"), **kw)).first()[0]


def test_smape_counts_pairs_of_zeros(spark):
    rows = [(0.0, 0.0), (1.0, 1.0), (2.0, 1.0)]
    assert scores(spark, rows) == pytest.approx(200 / 9)
    swapped = [(t, p) for p, t in rows]
    assert scores(spark, swapped) == pytest.approx(200 / 9)


def test_smape_bounds_and_missing_pairs(spark):
    assert scores(spark, [(1.0, -1.0), (5.0, 0.0)]) == pytest.approx(200.0)
    assert scores(spark, [(1.0, None), (None, 1.0)]) is None
    assert scores(spark, [(1.0, 1.0), (1.0, None)]) == 0.0


def test_log_target_round_trip(spark):
    df = spark.createDataFrame([(0.0,), (3.5,), (None,)], "y double")
    got = [r[0] for r in df.select(from_log(to_log(F.col("y")))).collect()]
    assert got == [0.0, pytest.approx(3.5), None]


def test_noise_is_repeatable_and_of_the_set_spread(spark):
    df = spark.range(20000, numPartitions=4)
    first = df.select(noise(1.6, 3).alias("e"))
    assert first.agg(F.stddev("e")).first()[0] == pytest.approx(1.6, abs=0.05)
    assert [r[0] for r in first.collect()] == [r[0] for r in df.select(noise(1.6, 3)).collect()]


def test_shown_values_stay_doubles(spark):
    from seriesloom.plans.registry import rounded

    values = [2e15, 2e300, float("inf"), float("-inf"), float("nan"), None, 0.15375, 1.00005, -0.00001, -2.34567]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(rounded(F.col("v")).alias("r"))
    assert rows.dtypes == [("r", "double")]
    assert "bigint" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = [r["r"] for r in rows.collect()]
    assert got[:4] == values[:4] and got[4] != got[4] and got[5] is None
    assert got[6:] == [0.1538, 1.0001, 0.0, -2.3457] and str(got[8]) == "0.0"


def test_submission_keeps_long_ids(spark):
    from seriesloom.operators.combine import submission

    df = spark.createDataFrame([(3_000_000_000, 1.0)], "id long, p double")
    assert submission(df, "id", F.col("p"), "sales").first()["id"] == 3_000_000_000


def test_wide_tables_are_rounded_in_batches_bit_by_bit(spark):
    from seriesloom.plans.registry import rounded, rounded_in_batches

    values = [None, 0.0, -0.0, float("nan"), float("inf"), float("-inf"), 5e-324, 0.49999999999999994, -0.5, 1 / 512, -3 / 512]
    values += [0.00195, 1.00005, -2.34567, 8.99e7, 9e7, 9e10, 9e11, 4503599627370497.0, 9e15, -1e300, 0.125 + 2.0**40]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4, 7):
        both = df.select(rounded(F.col("v"), digits).alias("a"), rounded_in_batches(digits)(F.col("v")).alias("b"))
        assert len(both.collect()) == len(values)
        assert both.where("not (a <=> b) or cast(a as string) <> cast(b as string)").collect() == []


def test_no_rounded_table_outgrows_the_compiler(spark, capsys):
    """The JVM interprets methods above 8,000 bytes; 30 columns rounded by expressions made one of 14,352."""
    import re

    from seriesloom.plans.registry import WIDE, shown

    for n in (WIDE, 30):
        df = spark.range(4).select(*[(F.rand(i) * i).alias(f"c{i}") for i in range(n)], F.lit(2.5).cast("float").alias("f"))
        capsys.readouterr()
        out = shown(df.drop("f") if n == WIDE else df)
        out.explain("codegen")
        sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000
        assert {t for _, t in out.dtypes} == {"double"}
