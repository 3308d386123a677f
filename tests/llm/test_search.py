"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import ROWS, words

from seriesloom.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = {i: i + 32 for i in range(65, 91)}


def found(text):
    return TERM.findall((text or "").translate(ASCII))


def plain(rows, items, k=20):
    """(item_id, rank, doc_id, score) by the contract's formulas."""
    docs = [(i, Counter(t), len(t)) for i, t in ((i, found(t)) for i, t in rows) if t]
    n, total = len(docs), sum(m for *_, m in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, m in docs:
            norm = 75 + (25 * m * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * norm)) for t in found(text) if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


ITEMS = [(1, words(30, 1)), (2, "One TWO two, don't…日本 Ünïcode"), (3, None), (4, ""), (5, "unheardof"), (6, words(40, 5) + " id no"), (6, "b"), (6, "b")]


def test_defined_cases(spark, docs):
    items = spark.createDataFrame([(*i, 5) for i in ITEMS], "item_id long, text string, score int")
    ranked = search.ranked(docs(ROWS), items)
    assert got(ranked) == plain(ROWS, ITEMS[:-1])
    assert dict(ranked.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    # Many blocks of items give the same rows.
    assert got(search.ranked(docs(ROWS), items, block=60)) == plain(ROWS, ITEMS[:-1])
    assert search.ranked(docs(ROWS[:1]), items).count() == 0
    assert search.ranked(docs(ROWS), items.limit(0)).count() == 0


def test_common_and_rare_terms_over_many_windows(spark, docs, monkeypatch):
    r = random.Random(4)
    weights = [1 / (i + 1) for i in range(3000)]
    rows = [(i * 7 % 4001, " ".join(f"t{x}" for x in r.choices(range(3000), weights, k=r.randrange(1, 60)))) for i in range(4001)]
    # A third are copies, so that many scores are equal.
    rows += [(10_000 + i, rows[i % 50][1]) for i in range(2000)]
    items = [(i, " ".join(f"t{x}" for x in r.choices(range(3000), weights, k=25))) for i in range(30)]
    monkeypatch.setattr(search, "SHORT", 40)
    monkeypatch.setattr(search, "WINDOW", 64)
    ranked = search.ranked(docs(rows, 4), spark.createDataFrame(items, "item_id long, text string"))
    assert got(ranked) == plain(rows, items)


@pytest.mark.parametrize("short", [0, 10, 10_000])
def test_segment_search_is_exact_and_skips(monkeypatch, short):
    """Whatever goes to the accumulators, the same documents come out; most windows are never opened."""
    monkeypatch.setattr(search, "SHORT", short)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"t{x}" for x in rng.zipf(1.3, 30) % 500) for _ in range(5000)]
    known = np.unique(np.concatenate([w for _, w, _ in search.terms(texts)]))
    segment = search.Segment()
    for first, hashed, ends in search.terms(texts):
        segment.add(list(range(first, first + len(ends))), hashed, ends, known)
    row = {k: v[0] for k, v in segment.row().to_pydict().items()}
    lists = search.Lists.of(row, 5000, 150_000)
    df = np.array([z - a for a, z in lists.begins.values()])
    weight = dict(zip(lists.begins, search.term_weights(5000, df).tolist(), strict=True))
    for _ in range(20):
        item = [(t, weight[t]) for t in rng.choice(list(weight), 12, replace=False).tolist() if weight[t]]
        best = search.Best(20)
        search.search(lists, item, best, np.arange(5000), np.zeros(5000, bool))
        total = np.zeros(5000, np.int64)
        for t, w in item:
            a, z = lists.begins[t]
            total[lists.document[a:z]] += lists.impact[a:z] * w
        order = np.lexsort((np.arange(5000), -total))[:20]
        order = order[total[order] > 0]
        assert best.doc_id.tolist() == order.tolist() and best.score.tolist() == total[order].tolist()


def test_segments_cut_by_size(spark, docs, monkeypatch):
    monkeypatch.setattr(search, "SEGMENT", 100)
    known = np.unique(np.concatenate([w for _, w, _ in search.terms([words(50, 1)])]))
    rows = [(i, words(10, i)) for i in range(50)] + [(99, words(50, 1)), (100, None)]
    index = search.segments(docs(rows, 1), known)
    assert sum(r.documents for r in index.collect()) == 51


def test_string_ids_are_refused(spark):
    rows = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    with pytest.raises(ValueError, match="integer"):
        search.ranked(rows, spark.createDataFrame([(1, "x")], "item_id long, text string"))
