import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom import Panel
from seriesloom.operators import combine, histograms, quantiles, skew, summarize
from seriesloom.operators.quantiles import exact_quantiles
from seriesloom.operators.skew import salted_join

PROBS = (0.0, 0.05, 0.25, 0.5, 0.95, 0.99, 1.0)


def values_of(kind, n=2000):
    rng = np.random.default_rng(4)
    return {
        "flat": rng.uniform(-5, 5, n),
        "long tail": np.concatenate([rng.lognormal(0, 3, n - 1), [1e14]]),
        "few values": rng.integers(0, 3, n).astype(float),
        "one value": np.full(n, 7.25),
        "tiny range": 1e6 + rng.uniform(0, 1e-6, n),
        "crowded": np.concatenate([[0.0, 1e9], 0.5 + rng.uniform(0, 1e-9, n - 2)]),
        "below zero": -rng.lognormal(0, 4, n),
        "with gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
    }[kind]


@pytest.mark.parametrize("kind", ["flat", "long tail", "few values", "one value", "tiny range", "crowded", "below zero", "with gaps"])
def test_quantiles_equal_pandas(spark, kind):
    v = pd.Series(values_of(kind))
    df = spark.createDataFrame([(float(x) if x == x else None,) for x in v], "v double").repartition(5)
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], PROBS).collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(v.quantile(p), rel=1e-12)


def test_large_buckets_are_split_again(spark, monkeypatch):
    """With a limit of a few rows per bucket, crowded values take several rounds."""
    monkeypatch.setattr(quantiles, "SORTED_ROWS", 5)
    rounds = []
    for name in ("_narrow", "narrowed"):
        narrow = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, narrow=narrow: rounds.append(1) or narrow(*a))
    for by in ([], ["g"]):
        rounds.clear()
        v = pd.Series(values_of("crowded", 300))
        df = spark.createDataFrame([("a", float(x)) for x in v], "g string, v double")
        got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], PROBS, by=by).collect()}
        assert got == {p: pytest.approx(v.quantile(p), rel=1e-12) for p in PROBS}
        assert len(rounds) > 1


def test_grouped_quantiles_with_a_hot_group(spark):
    """One group holds most rows, one has a single row, and rows without a group are left out."""
    rng = random.Random(3)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(3000)] + [("cold", rng.gauss(5, 1)) for _ in range(50)]
    rows += [("one", 1.5), (None, 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = exact_quantiles(df, ["v"], PROBS, by=["g"]).collect()
    frame = pd.DataFrame(rows, columns=["g", "v"])
    assert {r["g"] for r in got} == {"hot", "cold", "one"}
    for r in got:
        assert r["value"] == pytest.approx(frame[frame.g == r["g"]].v.quantile(r["prob"]), rel=1e-12)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert {r["column"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()} == {"b"}


def test_bounds_part_any_doubles():
    tiny, huge = 5e-324, 1.7e308
    for low, high in ((0.0, 1.0), (-huge, huge), (-tiny, tiny), (tiny, huge), (-huge, -1.0), (1.0, np.nextafter(1.0, 2)), (-0.0, 0.0), (3.0, 3.0)):
        cut = histograms.bounds(low, high, 64)
        assert cut[0] == low and cut[-1] <= high and (np.diff(cut) > 0).all()
        # A range of more than one double is always parted.
        assert len(cut) > 1 or low == high
    places = [histograms._place(x) for x in (-float("inf"), -huge, -tiny, 0.0, tiny, 1.0, huge, float("inf"))]
    assert places == sorted(places) and places[3] - places[2] == places[4] - places[3] == 1
    assert [histograms._double(histograms._place(x)) for x in (-2.5, 0.0, 7.25)] == [-2.5, 0.0, 7.25]


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_quantiles_of_columns_side_by_side(spark, monkeypatch, limit):
    """Columns of all kinds in one go: infinities, missing values, ties, one value, whole numbers."""
    monkeypatch.setattr(quantiles, "SORTED_ROWS", limit)
    infinity, rng = float("inf"), np.random.default_rng(8)
    table = {kind: values_of(kind, 400) for kind in ("flat", "long tail", "few values", "one value", "crowded", "with gaps")}
    table["ends"] = np.where(rng.random(400) < 0.1, -infinity, np.where(rng.random(400) < 0.2, infinity, rng.normal(size=400)))
    table["endless"] = np.full(400, infinity)
    table["lost"] = np.full(400, np.nan)
    names = list(table)
    df = spark.createDataFrame(pd.DataFrame(table), ", ".join(f"`{n}` double" for n in names)).withColumn("whole", F.monotonically_increasing_id()).repartition(5)
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, [*names, "whole"], PROBS).collect()}
    assert len(got) == len(PROBS) * len(names)
    for name in set(names) - {"lost"}:
        v = np.sort(table[name][~np.isnan(table[name])])
        for p in PROBS:
            place = p * (len(v) - 1)
            a, b = v[math.floor(place)], v[math.ceil(place)]
            expected = a if a == b or place == math.floor(place) else a + (b - a) * (place - math.floor(place))
            assert got[name, p] == expected or got[name, p] == pytest.approx(expected, rel=1e-12), (name, p)


def test_salted_join_is_a_join(spark):
    big = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)], "k string, i int")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    for how in ("inner", "left"):
        got = sorted(salted_join(big, small, ["k"], F.col("i"), how).select("k", "i", "v").collect())
        assert got == sorted(big.join(small, "k", how).select("k", "i", "v").collect())
    with pytest.raises(ValueError):
        salted_join(big, small, ["k"], F.col("i"), "full")


def test_hot_keys_are_split_as_their_rows_ask_for(spark, monkeypatch):
    rows = [("a", i) for i in range(250)] + [("b", i) for i in range(101)] + [("c", i) for i in range(100)] + [(None, i) for i in range(400)]
    big = spark.createDataFrame(rows, "k string, i int").repartition(4)
    assert {r["k"]: r["_ways"] for r in skew.hot_keys(big, ["k"], 100).collect()} == {"a": 3, "b": 2}
    assert skew.hot_keys(big, ["k"]).count() == 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # No more parts than tasks, and no more hot keys than tasks: the largest.
    assert {r["_ways"] for r in skew.hot_keys(big, ["k"], 1).collect()} == {tasks}
    many = spark.range(1000).selectExpr("id % 100 AS k", "id AS i")
    assert skew.hot_keys(many, ["k"], 1).count() == tasks

    monkeypatch.setattr(skew, "ROWS_OF_A_KEY", 100)
    small = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), ("d", 4), (None, 5)], "k string, v int")
    for how in ("inner", "left"):
        got = sorted(salted_join(big, small, ["k"], F.col("i"), how).select("k", "i", "v").collect(), key=str)
        assert got == sorted(big.join(small, "k", how).select("k", "i", "v").collect(), key=str)
    # A key of several columns, the hot ones known by the first alone.
    two = big.withColumn("m", F.col("i") % 2)
    few = spark.createDataFrame([("a", 0, 1), ("b", 1, 2)], "k string, m int, v int")
    got = sorted(salted_join(two, few, ["k", "m"], F.col("i"), "left", skew.hot_keys(big, ["k"])).select("k", "m", "i", "v").collect(), key=str)
    assert got == sorted(two.join(few, ["k", "m"], "left").select("k", "m", "i", "v").collect(), key=str)


def test_rows_of_a_hot_key_meet_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_OF_A_KEY", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        big = spark.range(3000).selectExpr("CASE WHEN id < 2900 THEN 'hot' ELSE 'cold' END AS k", "id")
        small = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
        joined = salted_join(big, small, ["k"], F.col("id")).withColumn("at", F.spark_partition_id())
        most = joined.where("k = 'hot'").groupBy("at").count().agg(F.max("count"), F.count("*")).first()
        assert most[1] > 1 and most[0] < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_statistics_follow_the_missing_value_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", None), ("c", 3.0), (None, 9.0)], "k string, y double")
    got = {
        r["k"]: r
        for r in summarize.group_statistics(df, ["k"], {"y": ["sum", "mean", "median", "std", "count"]}).collect()
    }
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["y_std"] == pytest.approx(1.527525, abs=1e-6)
    assert got["a"]["y_median"] == 2.0
    assert got["b"]["y_sum"] == 0.0 and got["b"]["y_mean"] is None and got["b"]["y_count"] == 0
    assert got["c"]["y_std"] is None


def test_quantile_fixture(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 10.0)], "v double")
    row = summarize.quantile_table(df).first()
    assert [round(row[c], 6) for c in ("q0", "q0_05", "q0_5", "q0_95", "q0_99", "q1")] == [1, 1.2, 3, 8.8, 9.76, 10]


def test_describe_equals_pandas(spark):
    v = pd.Series(values_of("with gaps", 500))
    df = spark.createDataFrame([(float(x) if x == x else None,) for x in v], "v double")
    got = {r["stat"]: r["value"] for r in summarize.describe_column(df, "v").collect()}
    expected = v.describe(percentiles=[0.1, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99])
    assert set(got) == set(expected.index)
    for k, x in expected.items():
        assert got[k] == pytest.approx(x)


def test_null_counts_take_nan_for_missing(spark):
    df = spark.createDataFrame([(None, float("nan"), "x"), (1, 2.0, None)], "a int, b double, c string")
    assert {r[0]: r[1] for r in summarize.null_counts(df).collect()} == {"a": 1, "b": 1, "c": 1}


def test_profile_sections(spark):
    df = spark.createDataFrame([(i, float(i), f"n{i}") for i in range(20)], "i int, v double, n string")
    got = summarize.profile(df, ["i"], head=2).collect()
    cells = {(r["section"], r["column_name"], r["stat"]): (r["value"], r["text"]) for r in got}
    assert cells[("shape", None, "rows")] == (20.0, None)
    assert cells[("types", "n", "dtype")] == (None, "string")
    assert cells[("head", "n", "row 1")] == (None, "n0")
    assert cells[("tail", "i", "row 1")] == (19.0, None)
    assert cells[("quantiles", "v", "0.5")] == (9.5, None)


def test_box_statistics_count_outliers(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 2.0)]
    got = {r["k"]: r for r in summarize.box_statistics(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert got["a"]["n_outliers"] == 1 and got["a"]["whisker_high"] == 5.0 and got["a"]["whisker_low"] == 1.0
    assert got["b"]["q1"] == got["b"]["q3"] == 2.0 and got["b"]["n_outliers"] == 0


@pytest.mark.parametrize("n", [9, 10, 20, 21, 500])
def test_classes_at_their_limits(spark, n):
    df = spark.range(2000).select(
        (F.col("id") % n).cast("int").alias("i"),
        (F.col("id") % n).cast("string").alias("s"),
        F.when(F.col("id") % 2 == 0, True).alias("flag"),
        F.lit(None).cast("double").alias("none"),
    )
    got = {r["column_name"]: r["class"] for r in summarize.classify_columns(df).collect()}
    assert got["i"] == ("categorical" if n < 10 else "numeric")
    assert got["s"] == ("cardinal" if n > 20 else "categorical")
    assert got["flag"] == got["none"] == "categorical"
    assert set(got) == set(df.columns)


def test_stack_fills_missing_columns(spark):
    train = spark.createDataFrame([(1, 2.0)], "d int, sales double")
    test = spark.createDataFrame([(7, 3)], "id int, d int")
    got = combine.stack(train, test)
    assert got.columns == ["d", "sales", "id"]
    assert sorted(got.collect(), key=str) == [(1, 2.0, None), (3, None, 7)]


def test_covariate_join_keeps_both_unmatched_sides(spark):
    rows = [("a", dt.date(2020, 1, 2), 1.0), ("b", dt.date(2020, 1, 2), 2.0), ("a", dt.date(2020, 1, 1), 3.0), ("c", None, 4.0)]
    left = spark.createDataFrame(rows, "k string, d date, y double")
    right = spark.createDataFrame(
        [(dt.date(2020, 1, 2), 9.0, 1.0), (dt.date(2020, 1, 3), 8.0, 1.0), (None, 7.0, 1.0)], "d date, price double, low double"
    )
    got = combine.join_covariate(left, right, "d", drop=["low"])
    plain = left.join(right, "d", "full").drop("low")
    assert sorted(got.select(*plain.columns).collect(), key=str) == sorted(plain.collect(), key=str)


def test_one_hot_values_in_order_and_missing_all_zero(spark):
    df = spark.createDataFrame([(10, "b"), (2, "a"), (None, None)], "n int, s string")
    got = combine.one_hot(df, ["n", "s"])
    assert got.columns == ["n_2", "n_10", "s_a", "s_b"]
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0, 0, 0), (0, 1, 0, 1), (1, 0, 1, 0)]
    with pytest.raises(ValueError):
        combine.category_values(spark.range(50).select(F.col("id").cast("int").alias("n")), ["n"], limit=10)


def test_splits_are_disjoint_and_complete(spark):
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i) if i < 8 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, ts date, y double")
    panel = Panel(df, ("k",), "ts", "y")
    parts = combine.split_by_position(panel, 4)
    assert parts.where("part = 'train'").agg(F.max("ts")).first()[0] == dt.date(2020, 1, 4)
    assert parts.count() == 10
    known, unknown = combine.split_by_target(df, "y")
    assert (known.count(), unknown.count()) == (8, 2)
    tagged = combine.tag_split(df, "ts", "2020-01-05", "2020-01-08")
    assert {r["part"]: r["count"] for r in tagged.groupBy("part").count().collect()} == {"train": 4, "valid": 3}
    assert combine.through(df, "ts", "2020-01-02", "2020-01-03").count() == 2
    assert combine.between(df, "ts", "2020-01-02", "2020-01-03").count() == 1
    assert combine.unmatched(df.limit(0), df, ["k", "ts"]).count() == 10
    assert combine.all_but(df, "k", "y") == ["ts"]
    assert combine.cast_if_present(df, "week", "int").columns == df.columns
    assert dict(combine.cast_if_present(df, "y", "int").dtypes)["y"] == "int"


def test_panel_checks_its_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        Panel(df, ("k",), "ts", "y")


def test_aggregate_drops_rows_without_a_key(spark):
    rows = [("a", dt.datetime(2020, 1, 1, 5), 1.0), ("a", dt.datetime(2020, 1, 1, 7), 2.0), (None, dt.datetime(2020, 1, 1), 4.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    panel = Panel.aggregate(df, ["k"], "t", {"y": F.sum("v")})
    assert [tuple(r) for r in panel.df.collect()] == [("a", dt.date(2020, 1, 1), 3.0)]
    assert panel.calendar_bound
    assert not Panel.aggregate(df, ["k"], "t", {"y": F.sum("v")}, period="hour").calendar_bound


def test_overlays_agree(spark):
    rows = [("a", i, float(i), float(i) / 2, "train" if i < 3 else "test") for i in range(5)]
    df = spark.createDataFrame(rows, "k string, ts int, y double, p double, part string")
    cut = lambda part, c: df.where(F.col("part") == part).select("k", "ts", F.col(c).alias("y"))
    three = combine.overlay(cut("train", "y"), cut("test", "y"), cut("test", "p"))
    one = combine.overlay_marked(df, ["k", "ts"], "y", "p")
    assert sorted(one.collect()) == sorted(three.select(*one.columns).collect())
    assert one.count() == 7


def test_quantiles_of_infinities(spark):
    from seriesloom.operators.quantiles import exact_quantiles

    inf = float("inf")
    values = [-inf, 1.0, 2.0, 3.0, inf, None, float("nan"), inf, 4.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", inf)], "k string, v double")
    got = {(r["k"], r["prob"]): r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], ["k"]).collect()}
    assert got == {("a", 0.0): -inf, ("a", 0.5): 3.0, ("a", 1.0): inf, ("b", 0.0): inf, ("b", 0.5): inf, ("b", 1.0): inf}
    whole = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.5]).collect()}
    assert whole == {0.0: -inf, 0.5: 3.5}


def test_quantiles_of_a_range_that_is_no_double(spark):
    from seriesloom.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(v,) for v in (-1.7e308, -1.0, 0.0, 2.0, 1.7e308)], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    assert got == {0.0: -1.7e308, 0.25: -1.0, 0.5: 0.0, 0.75: 2.0, 1.0: 1.7e308}
    ends = spark.createDataFrame([(-1.7e308,), (1.7e308,)], "v double")
    assert exact_quantiles(ends, ["v"], [0.5]).first()["value"] == 0.0


@pytest.mark.parametrize("many", [20, 5000, 200_000])
def test_column_classes_at_any_limit(spark, many):
    nan = float("nan")
    rows = [(f"v{i % 6000}", float(i % 9) if i % 2 else nan, i) for i in range(12_000)]
    df = spark.createDataFrame(rows, "t string, f double, n long")
    got = {r["column_name"]: r["class"] for r in summarize.classify_columns(df, 10, many).collect()}
    assert got == {"t": "cardinal" if many < 6000 else "categorical", "f": "categorical", "n": "numeric"}
