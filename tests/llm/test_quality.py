import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import ROWS, words

from seriesloom.llm import quality


def base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    often = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if often[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, text string")


def test_base_rules(spark, docs):
    rows = [*ROWS, (30, "\n".join(["# a | b"] * 9)), (31, words(60, 3) + "\n" + words(30, 4) + "\n \n" + words(30, 4))]
    got = quality.judged(docs(rows), labelled(spark, [])).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter((i, *base(t)) for i, t in rows)
    assert all(r.kept == (not r.base_failed) and r.probability is None for r in got)


def test_sizes_of_runs_do_not_matter(monkeypatch):
    model = quality.Model(np.random.default_rng(0).standard_normal(1 << quality.BITS), 0.1, 1.0, 0.0)
    texts = [t for _, t in ROWS]

    def judged():
        return np.concatenate([m.probability(r) if (m := model) else [] for r in quality.runs(texts)]), [tuple(map(int, x)) for r in quality.runs(texts) for x in zip(*r.counts([t or "" for t in texts[r.first : r.first + len(r.data)]]).values(), strict=True)]

    p, counts = judged()
    for module in (quality, __import__("seriesloom.llm.words", fromlist=["x"])):
        monkeypatch.setattr(module, "SLICE", 2000)
    q, again = judged()
    assert counts == again and p == pytest.approx(q)


def test_vectors_give_the_same_score():
    weights = np.random.default_rng(1).standard_normal(1 << quality.BITS)
    for run in quality.runs([t for _, t in ROWS]):
        assert [float(weights[c] @ v) for c, v in run.vectors()] == pytest.approx(run.score(weights))


def test_held_out_accuracy(spark, docs):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        good = r.random() < 0.8
        text = words(r.randint(60, 200), i)
        rows.append((i, text if good else " ".join(w + r.choice(["***", "!!", " |"]) for w in text.upper().split())))
        if i < 500:
            labels.append((i, int(good), "clash"))
        rows[-1] += (good,)
    labels += [(3, None, ""), (4, 7, ""), (None, 1, "")]
    got = {x.doc_id: x for x in quality.judged(docs([x[:2] for x in rows]), labelled(spark, labels)).collect()}
    fresh = [x for x in rows if x[0] >= 500]
    assert all(got[i].kept == good for i, _, good in fresh)
    loss = -np.mean([np.log(got[i].probability if good else 1 - got[i].probability) for i, _, good in fresh])
    assert loss < 0.1


def test_empty_table(spark, docs):
    assert quality.judged(docs([]), labelled(spark, [])).count() == 0


def test_platt():
    x = np.linspace(-3, 3, 400)
    good = (np.random.default_rng(2).random(400) < 1 / (1 + np.exp(-(2 * x + 0.5)))).astype(float)
    slope, shift = quality.platt(x, good)
    assert slope == pytest.approx(2, abs=0.5) and shift == pytest.approx(0.5, abs=0.4)


def test_fit_is_the_least_loss():
    """At the weights found no cell's slope is left; rows that don't count change nothing."""
    rng = np.random.default_rng(4)
    cells = [np.unique(rng.integers(0, 300, rng.integers(0, 40))).astype(np.int32) for _ in range(700)]
    values = [rng.random(len(c)).astype(np.float32) * 3 for c in cells]
    truth = rng.normal(size=300)
    good = np.array([float(truth[c] @ v + rng.normal() > 0) for c, v in zip(cells, values, strict=True)])
    counts = (rng.random(700) < 0.8).astype(float)
    rows = [quality.packed(c, v) for c, v in zip(cells, values, strict=True)]
    blocks = [quality.Rows.of(rows[at : at + 64]) for at in range(0, 700, 64)]
    assert (np.concatenate([b.cells for b in blocks]) == np.concatenate(cells)).all()
    w = quality.fit_weights(blocks, good, counts, 300, rounds=300)
    x = np.zeros((700, 300))
    for i, (c, v) in enumerate(zip(cells, values, strict=True)):
        x[i, c] = v
    error = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - good) * counts / counts.sum()
    assert np.abs(x.T @ error + quality.PENALTY * w[:-1]).max() < 1e-3 and abs(error.sum()) < 1e-3
    other = quality.fit_weights(blocks, np.where(counts > 0, good, 1 - good), counts, 300, rounds=300)
    assert np.abs(other - w).max() < 1e-9
