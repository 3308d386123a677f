from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import ROWS, edited, words

from seriesloom.llm import minhash
from seriesloom.llm.components import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    """(n_shingles, least doc_id of the component) per row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))], len(groups)


def check(docs, rows):
    got = minhash.near_duplicates(docs(rows)).collect()
    want, groups = expected(rows)
    order = repr
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=order) == sorted(want, key=order)
    kept = [r for r in got if r.kept]
    assert len(kept) == groups
    assert all(r.doc_id == r.component_id for r in kept)


def test_equals_all_pairs(docs):
    check(docs, ROWS)


def test_group_of_near_copies(docs):
    """Near and far copies of one text, so that buckets hold several components."""
    base = words(150, 11)
    check(docs, [(i, edited(base, 3 + i % 40, i)) for i in range(150)] + [(500 + i, words(120, 90 + i)) for i in range(20)])


def test_blocks_of_leaders(docs, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    base = words(150, 12)
    check(docs, [(i, edited(base, 9 + i % 9, i)) for i in range(60)])


def test_empty_table(docs):
    assert minhash.near_duplicates(docs([])).count() == 0


def test_pruning_gives_up_far_pairs_only():
    steps = minhash.least_matches()
    assert all(least <= 0.75 * n for n, least in steps)
    assert steps[-1][1] > 0.3 * steps[-1][0]


def test_components(spark):
    draw = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(500):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if k != v}


@pytest.mark.parametrize("cut", [1, 3])
def test_other_partitions_same_result(docs, cut):
    rows = ROWS[3:12]
    a = {tuple(r) for r in minhash.near_duplicates(docs(rows, cut)).select("doc_id", "component_id", F.col("kept")).collect()}
    assert a == {tuple(r) for r in minhash.near_duplicates(docs(rows, 2)).select("doc_id", "component_id", "kept").collect()}
