import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import words

from seriesloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, hash string, tokens long"


def table(spark, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, words(20 + i % 40, i), source, "en", 0))
            i += 1
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def totals(df):
    out = Counter()
    for r in df.collect():
        out[r.source] += len((r.text or "").split())
    return out


def test_repetition_limit(spark):
    docs = table(spark, {"a": 300, "b": 60, None: 20})
    have, mixed = totals(docs), mixing.mixed(docs, mixing.Target(repeated=2.0))
    got = totals(mixed)
    assert {r.doc_id for r in mixed.collect()} == set(range(380))
    top = max(have, key=have.get)
    low, high = have[None] / sum(have.values()), have[top] / sum(have.values())
    power = 1 - math.log(2) / math.log(high / low)
    for s in have:
        want = have[top] * (have[s] / have[top]) ** power
        assert want - 60 <= got[s] <= want + 1
    assert got[None] <= 2 * have[None]


def test_entropy_and_budget(spark):
    docs = table(spark, {"a": 300, "b": 60, "c": 20})
    have = totals(docs)
    shares = {s: n / sum(have.values()) for s, n in have.items()}

    def entropy(a):
        z = sum(p**a for p in shares.values())
        return -sum(p**a / z * math.log(p**a / z) for p in shares.values())

    goal = (entropy(1) + math.log(3)) / 2
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) >= goal else (low, mid)
    z = sum(p**low for p in shares.values())
    got = totals(mixing.mixed(docs, mixing.Target(entropy=goal), budget=5000))
    for s, p in shares.items():
        assert 5000 * p**low / z - 60 <= got[s] <= 5000 * p**low / z + 1


def test_passes_take_blocks_in_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    docs = table(spark, {"a": 200, "b": 40})
    rows = mixing.mixed(docs, mixing.Target(repeated=2.5)).collect()
    seen = Counter((r.doc_id, r["mix pass"]) for r in rows)
    assert set(seen.values()) == {1}
    whole = {(r.doc_id, r["mix block"]) for r in rows if r["mix pass"] == 0 and r.source == "b"}
    assert len({b for _, b in whole}) > 4
    # The last pass over b takes blocks up to one rank; below it every document of a block.
    last = max(r["mix pass"] for r in rows if r.source == "b")
    taken = [r["mix block"] for r in rows if r.source == "b" and r["mix pass"] == last]
    assert len(taken) < 40 and len(set(taken)) >= max(taken)


def test_odd_rows(spark):
    rows = [(1, None, "a", "", 0), (1, None, "a", "", 0), (2, "", None, "", 0), (None, "x y", "b", "", 0)]
    got = mixing.mixed(spark.createDataFrame(rows, SCHEMA), mixing.Target(repeated=1.5))
    assert got.count() == 4 and got.columns[:5] == ["doc_id", "text", "source", "hash", "tokens"]
    assert mixing.mixed(spark.createDataFrame([], SCHEMA), mixing.Target(repeated=1.5)).count() == 0


def test_exponent_limits(spark):
    sources = spark.createDataFrame([("a", 90, 0.9), ("b", 10, 0.1)], "source string, tokens long, share double")
    assert mixing.exponent(sources, mixing.Target(entropy=9.0)) == 0.0
    assert mixing.exponent(sources, mixing.Target(entropy=0.0)) == 1.0
    assert mixing.exponent(sources, mixing.Target(repeated=100.0)) == 0.0
    assert mixing.exponent(sources, mixing.Target(repeated=3.0)) == pytest.approx(0.5, abs=1e-6)


def test_no_document_is_lost_at_any_size(spark):
    """Shares of all kinds at 1e12 tokens: every source is passed over whole at least once, the largest exactly once."""
    r = random.Random(1)
    rows = []
    for mix in range(200):
        parts = [r.random() ** 3 + 1e-4 for _ in range(r.randrange(2, 9))]
        rows.append([(f"{mix}.{i}", int(1e12 * p / sum(parts))) for i, p in enumerate(parts)])
    for tokens in rows[:: 200 // 25]:
        total = sum(n for _, n in tokens)
        sources = spark.createDataFrame([(s, n, n / total) for s, n in tokens], "source string, tokens long, share double")
        power = mixing.exponent(sources, mixing.Target(repeated=1.5))
        got = {x.source: x for x in mixing.plan(sources, power).collect()}
        most = max(tokens, key=lambda x: x[1])
        for s, n in tokens:
            assert got[s].passes >= 1 and 0 <= got[s].left < n
            assert got[s].passes * n + got[s].left <= 1.5 * n * (1 + 1e-9)
        assert (got[most[0]].passes, got[most[0]].left) == (1, 0)


def test_columns_of_the_added_names(spark):
    docs = table(spark, {"a": 30, "b": 6}).withColumn("mix pass", F.lit("x")).withColumn("Mix Block_", F.lit(1)).withColumn("mix block", F.lit(2))
    mixed = mixing.mixed(docs, mixing.Target(repeated=2.0))
    assert mixed.columns == [*docs.columns, "mix pass_", "mix block__"]
    assert {r["mix pass"] for r in mixed.select("mix pass", "mix block__").collect()} == {"x"}
