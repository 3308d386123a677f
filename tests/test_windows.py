import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesloom import Panel
from seriesloom.operators import per_series, windows
from seriesloom.operators.decompose import decompose

DAY0 = dt.date(2020, 1, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def panel_of(spark, series, **kw):
    rows = [(k, day(i), None if v is None else float(v)) for k, values in series.items() for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return Panel(spark.createDataFrame(rows, "k string, ts date, y double"), ("k",), "ts", "y", **kw)


def column(panel, name, key="a"):
    rows = panel.frame().where(F.col("k") == key).orderBy("ts").collect()
    return [r[name] for r in rows]


def close(got, expected, rel=1e-9):
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        missing = e is None or (isinstance(e, float) and np.isnan(e))
        assert (g is None) == missing, (got, expected)
        if not missing:
            assert g == pytest.approx(e, rel=rel, abs=1e-9)


def triangular_by_definition(y, n, min_known=10):
    half = (n + 1) // 2
    rising = [(2 * (i + 1) / (n + 1)) if n % 2 else (2 * i + 1) / n for i in range(half)]
    weights = rising + rising[::-1][n % 2 :]
    out = []
    for t in range(len(y)):
        pairs = [(weights[j - (t - n)], y[j]) for j in range(max(0, t - n), t) if y[j] is not None]
        out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs) if len(pairs) >= min_known else None)
    return out


def gappy(length, seed, share=0.2):
    rng = random.Random(seed)
    return [None if rng.random() < share else rng.uniform(-50, 100) for _ in range(length)]


def test_lags_stay_in_their_series(spark):
    got = windows.lag_features(panel_of(spark, {"a": [1, 2, 3], "b": [10, 20]}), [1, 2])
    assert column(got, "y_lag_1") == [None, 1, 2]
    assert column(got, "y_lag_2", "b") == [None, None]


def test_rows_without_a_key_stay_and_get_no_features(spark):
    rows = [("1", day(0), 1.0), ("1", day(1), 2.0), (None, day(0), 3.0), (None, day(1), 4.0)]
    panel = Panel(spark.createDataFrame(rows, "k string, ts date, y double"), ("k",), "ts", "y")
    panel = windows.ewm_features(windows.lag_features(panel, [1]), [0.5], [1])
    rows = panel.frame().collect()
    assert len(rows) == 4 and "_null_spread" not in panel.frame().columns
    assert {(r["k"], r["y_lag_1"]) for r in rows} == {("1", None), ("1", 1.0), (None, None)}
    assert all(r["y_ewm_alpha_05_lag_1"] is None for r in rows if r["k"] is None)


def test_rolling_mean_needs_a_full_window(spark):
    got = windows.rolling_means(panel_of(spark, {"a": [1, 2, None, 4, 5, 6]}), (2,), shift=1)
    close(column(got, "roll2_shift1"), [None, None, 1.5, None, None, 4.5])


@pytest.mark.parametrize("n", [3, 4, 21, 28, 365, 546])
def test_triangular_mean_is_its_definition(spark, n):
    y = gappy(700, n)
    got = windows.triangular_means(panel_of(spark, {"a": y}), [n], min_known=min(10, n - 1))
    close(column(got, f"y_roll_mean_{n}"), triangular_by_definition(y, n, min(10, n - 1)), rel=1e-8)


def test_triangular_mean_of_large_values_keeps_its_digits(spark):
    y = [1e9 + v for v in np.random.default_rng(2).normal(size=600)]
    got = windows.triangular_means(panel_of(spark, {"a": y}), [91])
    close(column(got, "y_roll_mean_91"), triangular_by_definition(y, 91), rel=1e-14)


def test_ewm_with_gaps(spark):
    y = [1, None, 3, 4, None, None, 7]
    got = windows.ewm_means(panel_of(spark, {"a": y}), [0.5], shift=0)
    expected = [1, 1, 2.6, 3.461538, 3.461538, 3.461538, 6.402597]
    close(column(got, "ewm05"), expected, rel=1e-6)


@pytest.mark.parametrize("alpha", [0.99, 0.95, 0.7, 0.5, 0.1])
def test_ewm_equals_pandas_across_long_gaps(spark, alpha):
    y = gappy(300, 5) + [None] * 150 + gappy(100, 6) + [None] * 3
    got = windows.ewm_means(panel_of(spark, {"a": y}), [alpha], shift=1)
    expected = pd.Series(y, dtype=float).shift(1).ewm(alpha=alpha).mean()
    close(column(got, "ewm" + str(alpha).replace(".", "")), list(expected))


def test_lag_and_ewm_commute(spark):
    y = gappy(120, 8)
    got = windows.ewm_features(panel_of(spark, {"a": y}), [0.8], [9])
    expected = pd.Series(y, dtype=float).shift(9).ewm(alpha=0.8).mean()
    close(column(got, "y_ewm_alpha_08_lag_9"), list(expected))


def test_features_do_not_depend_on_partitions_or_row_order(spark):
    series = {k: gappy(60, i) for i, k in enumerate("abcdef")}
    panel = panel_of(spark, series)
    build = lambda p: windows.ewm_features(
        windows.triangular_means(windows.lag_features(p, [3]), [12]), [0.5], [2]
    ).frame()
    one = build(panel).orderBy("k", "ts").collect()
    other = build(panel.with_df(panel.df.orderBy(F.desc("y")).repartition(5))).orderBy("k", "ts").collect()
    assert one == other


def test_all_features_share_one_shuffle(spark, capsys):
    panel = panel_of(spark, {"a": [1, 2, 3]}, null_keys=False)
    panel = windows.lag_features(panel, [1, 2])
    panel = windows.triangular_means(panel, [12, 21])
    panel = windows.ewm_features(panel, [0.9, 0.5], [1, 7])
    panel.df.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


def test_first_rows(spark):
    got = windows.first_rows(panel_of(spark, {"a": list(range(9)), "b": [5]}), 5).df
    assert sorted(r["y"] for r in got.where("k = 'a'").collect()) == [0, 1, 2, 3, 4]
    assert got.where("k = 'b'").count() == 1


def test_spine_has_no_gaps_and_keeps_values(spark):
    rows = [("a", dt.date(2020, 1, 1), 1.0), ("a", dt.date(2020, 4, 1), 4.0), ("b", dt.date(2020, 2, 1), 2.0)]
    panel = Panel(spark.createDataFrame(rows, "k string, ts date, y double"), ("k",), "ts", "y")
    spine = windows.calendar_spine(panel, "month")
    assert [r["y"] for r in spine.df.where("k = 'a'").orderBy("ts").collect()] == [1.0, None, None, 4.0]
    filled = windows.backward_fill(spine)
    assert [r["y"] for r in filled.frame().where("k = 'a'").orderBy("ts").collect()] == [1.0, 4.0, 4.0, 4.0]


def test_spine_length_of_a_long_monthly_series(spark):
    rows = [("a", dt.date(1958, 3, 1), 1.0), ("a", dt.date(2001, 12, 1), 2.0)]
    panel = Panel(spark.createDataFrame(rows, "k string, ts date, y double"), ("k",), "ts", "y")
    spine = windows.calendar_spine(panel, "month").df
    assert spine.count() == 526
    assert spine.where("ts <= date'1997-12-01'").count() == 478
    assert spine.where("ts >= date'1998-01-01'").count() == 48


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3)), min_size=1, max_size=40))
def test_backward_fill_equals_pandas(spark, y):
    got = windows.backward_fill(panel_of(spark, {"a": y}), into="f")
    close(column(got, "f"), list(pd.Series(y, dtype=float).bfill()))


@pytest.mark.parametrize("model", ["additive", "multiplicative"])
def test_parts_add_up_and_season_is_centred(spark, model):
    y = [100 + i + 10 * np.sin(i * np.pi / 6) + (i * 7) % 5 for i in range(50)]
    panel = panel_of(spark, {"a": y})
    rows = decompose(panel, model=model).orderBy("ts").collect()
    season = [r["seasonal"] for r in rows[:12]]
    assert np.mean(season) == pytest.approx(0 if model == "additive" else 1, abs=1e-9)
    assert [r["trend"] for r in rows[:6]] == [None] * 6 and rows[-6]["trend"] is None
    for i in range(6, 44):
        r = rows[i]
        whole = (
            r["trend"] + r["seasonal"] + r["residual"]
            if model == "additive"
            else r["trend"] * r["seasonal"] * r["residual"]
        )
        assert whole == pytest.approx(y[i])
        assert r["trend"] == pytest.approx((sum(y[i - 5 : i + 6]) + (y[i - 6] + y[i + 6]) / 2) / 12)


def test_open_transform_runs_per_series_in_time_order(spark):
    got = per_series.transform_series(panel_of(spark, {"a": [1, 2, 3], "b": [5, 5]}), lambda s: s.shift(1), "z")
    assert column(got, "z") == [None, 1, 2] or np.isnan(column(got, "z")[0])
    stamped = Panel(got.df.withColumn("ts", F.col("ts").cast("timestamp")), ("k",), "ts", "y")
    with pytest.raises(TypeError):
        per_series.transform_series(stamped, lambda s: s, "z")


@pytest.mark.parametrize("days", [("2020-01-15", "2020-03-10"), ("2020-01-01", "2020-02-01", "2020-02-01")])
def test_spine_refuses_rows_off_the_calendar(spark, days):
    df = spark.createDataFrame([("a", dt.date.fromisoformat(d), 1.0) for d in days], "k string, ts date, y double")
    with pytest.raises(Exception, match="row"):
        windows.calendar_spine(Panel(df, ("k",), "ts", "y"), "month").df.collect()
