import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seriesloom import Panel
from seriesloom.operators import segments, windows

START = dt.datetime(2024, 1, 1)


def hot_panel(spark, n=4000, seed=1):
    """Three series; one holds nine tenths of the rows. Times repeat, ids do not. Some rows have no key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.9 else rng.choice(["b", "c"])
        value = None if rng.random() < 0.1 else rng.uniform(0, 10)
        rows.append((key, START + dt.timedelta(seconds=rng.randrange(n // 2)), i, value))
    rows += [(None, START, n + i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, y double")
    return Panel(df, ("k",), "ts", "y")


def order_panel(panel):
    """The same rows with an exact order as time, for the plain window operators."""
    return Panel(panel.df.withColumn("at", F.struct("ts", "id")), ("k",), "at", "y", bounded=True)


def build(panel):
    panel = windows.lag_features(panel, [1, 30])
    return windows.triangular_means(panel, [20, 31])


@pytest.mark.parametrize("rows", [1, 40, 333, 100_000])
def test_chunks_give_what_whole_series_give(spark, rows):
    panel = hot_panel(spark)
    names = ["y_lag_1", "y_lag_30", "y_roll_mean_20", "y_roll_mean_31"]
    got = segments.over_segments(panel, build, reach=32, tie_break=["id"], rows=rows, pieces=7)
    whole = build(order_panel(panel)).frame()
    rounded = [F.round(c, 6).alias(c) for c in names]
    assert set(got.columns) == {"k", "ts", "id", "y", *names}
    left = sorted(got.select("id", *rounded).collect(), key=lambda r: r["id"])
    right = sorted(whole.select("id", *rounded).collect(), key=lambda r: r["id"])
    assert left == right


def test_places_count_up_within_each_series(spark):
    panel = hot_panel(spark)
    keyed = panel.df.where("k is not null")
    placed = segments.number_rows(keyed, ["k"], ["ts", "id"], pieces=5)
    per_key = {}
    for r in sorted(placed.collect(), key=lambda r: (r["k"], r["ts"], r["id"])):
        per_key.setdefault(r["k"], []).append(r["_place"])
    assert all(v == list(range(1, len(v) + 1)) for v in per_key.values())
    # The hot series is cut into several pieces, none of which holds most of its rows.
    sizes = [r["count"] for r in placed.where("k = 'hot'").groupBy("_piece").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * sum(sizes)


def test_backward_fill_across_pieces(spark):
    panel = hot_panel(spark)
    sparse = panel.with_df(panel.df.withColumn("y", F.when(F.col("id") % 97 == 0, F.col("y"))))
    got = segments.backward_fill_long(sparse, "f", ["id"], pieces=9)
    whole = windows.backward_fill(order_panel(sparse), into="f").frame()
    key = lambda r: r["id"]
    assert sorted(got.select("id", "f").collect(), key=key) == sorted(whole.select("id", "f").collect(), key=key)


def test_plain_windows_warn_about_raw_timestamps(spark):
    with pytest.warns(UserWarning, match="segments"):
        windows.lag_features(hot_panel(spark, 50), [1])


def test_reach_is_worked_out_and_a_shorter_one_refused(spark):
    panel = hot_panel(spark, 600)

    def build_20(p):
        return windows.triangular_means(p, [20])

    with pytest.raises(ValueError, match="look back 20 rows"):
        segments.over_segments(panel, build_20, reach=5, tie_break=["id"], rows=15)
    got = segments.over_segments(panel, build_20, tie_break=["id"], rows=15, pieces=3)
    key = lambda r: r["id"]
    mean = F.round("y_roll_mean_20", 6).alias("m")
    whole = build_20(order_panel(panel)).frame()
    assert sorted(got.select("id", mean).collect(), key=key) == sorted(whole.select("id", mean).collect(), key=key)


def test_reach_of_features_of_features_adds_up(spark):
    panel = hot_panel(spark, 600)

    def build_twice(p):
        p = windows.lag_features(p, [7])
        return windows.rolling_means(p.measuring("y_lag_7"), (4,), shift=2)

    assert build_twice(order_panel(panel)).reach == 12
    got = segments.over_segments(panel, build_twice, tie_break=["id"], rows=12, pieces=3)
    key = lambda r: r["id"]
    mean = F.round("roll4_shift2", 6).alias("m")
    whole = build_twice(order_panel(panel)).frame()
    assert sorted(got.select("id", mean).collect(), key=key) == sorted(whole.select("id", mean).collect(), key=key)


def test_whole_series_features_are_refused_chunk_by_chunk(spark):
    with pytest.raises(ValueError, match="whole series"):
        segments.over_segments(hot_panel(spark, 50), lambda p: windows.ewm_features(p, [0.5], [7]), tie_break=["id"])
