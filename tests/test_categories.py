"""Codes and sparse indicators against plain sorting."""

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import categories, combine, skew


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, [10, 9, 100, None][i % 4], ["b", "a", None, "ü", ""][i % 5], 1.0) for i in range(60)]
    return spark.createDataFrame(data, "id int, number int, word string, code double").repartition(4)


def test_values_are_numbered_in_order(rows):
    index = {(r["column"], r["value"]): r["code"] for r in categories.category_index(rows, ["number", "word"]).collect()}
    words = sorted(["b", "a", "ü", ""])
    assert index == {**{("number", v): i for i, v in enumerate(["9", "10", "100"])}, **{("word", v): i for i, v in enumerate(words)}}


def test_codes_of_known_missing_and_new_values(rows, monkeypatch):
    for most in (10, 1_000_000):
        monkeypatch.setattr(skew, "ROWS_OF_A_KEY", most)
        index = categories.category_index(rows.where("number <> 100"), ["number", "word"])
        got = categories.coded(rows, ["number", "word"], index).collect()
        assert len(got) == 60
        numbers = {9: 0, 10: 1}
        assert all(r["number__code"] == numbers.get(r["number"]) for r in got)
        assert {r["word__code"] is None for r in got if r["word"] is None} == {True}


def test_sparse_indicators_are_those_of_one_hot(spark, rows):
    columns = ["number", "word"]
    got = {r["id"]: r["indicators"] for r in categories.sparse_one_hot(rows, columns).collect()}
    dense = combine.one_hot(rows, columns)
    names = [c for c in dense.columns if c not in ("id", "code")]
    for r in dense.collect():
        assert list(got[r["id"]].toArray()) == [r[n] for n in names]
    assert categories.sparse_one_hot(rows, columns).columns == [*rows.columns, "indicators"]
    assert categories.sparse_one_hot(rows.where("false"), columns, categories.category_index(rows, columns)).count() == 0
    with pytest.raises(ValueError):
        categories.sparse_one_hot(rows.where("false"), columns)


def test_a_hundred_thousand_values(spark):
    df = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id") % 100_000).alias("key"), (F.col("id") % 3).alias("third"))
    index = categories.category_index(df, ["key", "third"])
    facts = index.groupBy("column").agg(F.count("*").alias("n"), F.countDistinct("code").alias("codes"), F.max("code").alias("most")).collect()
    assert {(r["column"], r["n"], r["codes"], r["most"]) for r in facts} == {("key", 100_000, 100_000, 99_999), ("third", 3, 3, 2)}
    vector = categories.sparse_one_hot(df, ["key", "third"], index).where("key = 'k7' AND third = 1").first()["indicators"]
    assert vector.size == 100_003 and len(vector.indices) == 2 and vector.indices[1] == 100_001
