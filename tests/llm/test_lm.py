import math
import zlib
from collections import Counter

import pytest
from samples import ROWS, words

from seriesloom.llm import lm

LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*(text or "").translate(LOWER).encode().split(), b""]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(rows, m):
    single, pair = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            single.update(w)
            pair.update(zip([None, *w], w, strict=False))
    n, v = sum(single.values()), len(single)
    ones, twos = (sum(c == k for c in single.values()) for k in (1, 2))
    d = min(0.9, max(0.1, ones / max(1, ones + 2 * twos)))

    def p(w):
        return ((single[w] - d) if single[w] else d * v) / n if n else 1.0

    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for h, x in zip([None, *w], w, strict=False):
            seen = single[b""] if h is None else single[h]
            score += math.log10((pair[h, x] + m * p(x)) / (seen + m))
        out.append((i, held(i), len(w), sum(single[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("block", [3_000_000, 100])
def test_equals_counts_by_hand(docs, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    rows = ROWS + [(100 + i, words(40, i % 5, 30)) for i in range(40)]
    got = lm.scored(docs(rows)).collect()
    want = brute(rows, got[0].fallback_weight)
    key = repr
    for a, b in zip(sorted((tuple(r)[:7] for r in got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_weights_of_a_state_sum_to_one():
    import numpy as np

    u = lm.Unigrams(tokens=10, types=4, ones=2, twos=1)
    counts = np.array([5.0, 3, 1, 1, 0])  # the last stands for all unknown words
    pairs = np.array([2.0, 1, 0, 0, 0])
    assert (10 ** lm.arc_weights(counts, np.full(5, 3.0), pairs, u, 10.0)).sum() == pytest.approx(1)


def test_no_training_texts_and_empty_table(docs):
    only = [(i, "a b") for i in range(60) if held(i)]
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in lm.scored(docs(only)).collect())
    assert lm.scored(docs([])).count() == 0
