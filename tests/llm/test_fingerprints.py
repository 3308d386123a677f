import hashlib
import re
from collections import Counter

import xxhash
from samples import ROWS, words

from seriesloom.llm import fingerprints

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64((v & MASK).to_bytes(8, "little"), seed=seed).intdigest()
    return signed(seed)


def sketch(text):
    w = [signed(xxhash.xxh64(x.encode(), seed=42).intdigest()) for x in re.findall("[^\x20\x09-\x0d]+", text or "")]
    if len(w) < 3:
        found = {chained(w)} if w else set()
    else:
        found = {chained(w[i : i + 3]) for i in range(len(w) - 2) if min(w[i : i + 3]) in (w[i], w[i + 2])}
    return sorted(found)[:64]


def alike(a, b):
    both = sorted({*a, *b})[:64]
    return len([x for x in both if x in a and x in b]) / len(both) if both else 1.0


def test_equals_brute_force(docs):
    rows = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64(r[1].encode(), seed=42).intdigest())))
    want = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, e = sketch(text), sketch(edited)
        hexed = ["".join(f"{x & MASK:016X}" for x in s) for s in (a, e)]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *hexed, alike(a, e), alike(a, sketch(after))))
    got = [tuple(r) for r in fingerprints.edits(docs(ROWS)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_one_row_and_none(docs):
    row = fingerprints.edits(docs([(5, "abcdef")])).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0
    assert fingerprints.edits(docs([])).count() == 0


def test_no_python_in_the_plan(docs):
    plan = fingerprints.edits(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def all_anchors(text):
    w = [signed(xxhash.xxh64(x.encode(), seed=42).intdigest()) for x in re.findall("[^\x20\x09-\x0d]+", text or "")]
    if len(w) < 3:
        return [(chained(w), 0)] if w else []
    return [(chained(w[i : i + 3]), i) for i in range(len(w) - 2) if min(w[i : i + 3]) in (w[i], w[i + 2])]


def links(text):
    found = all_anchors(text)
    return Counter((a, b, q - p) for (a, p), (b, q) in zip([(None, 0), *found], found, strict=False))


def linked(a, b):
    x, y = links(a), links(b)
    both = (x | y).total()
    return (x & y).total() / both if both else 1.0


def test_all_anchors_equal_brute_force(docs):
    rows = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64(r[1].encode(), seed=42).intdigest())))
    want = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        stretches = [sum(h % 16 == 0 or j == len(a) - 1 for j, (h, _) in enumerate(a)) for a in (all_anchors(text), all_anchors(edited))]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *stretches, linked(text, edited), linked(text, after)))
    got = [(*r[:3], len(r[3]) // 16, len(r[4]) // 16, *r[5:]) for r in fingerprints.matched(docs(ROWS)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_order_repeats_and_short_passages_show(docs):
    x, y, shared = words(400, 21), words(400, 22), words(50, 23, 10**9)
    rows = [(1, x + " " + y), (2, y + " " + x), (3, x), (4, x + " " + x), (5, words(20_000, 24, 10**9) + " " + shared), (6, shared + " " + words(20_000, 25, 10**9))]
    got = {r.doc_id: r for r in fingerprints.matched(docs(rows)).collect()}
    assert 0.9 < got[1].near_next < 1 and got[1].fingerprint != got[2].fingerprint  # moved
    assert 0.45 < got[3].near_next < 0.55  # repeated
    assert got[5].near_next > 0  # 50 words of 20,000
    digests = [{p[i : i + 16] for i in range(0, len(p), 16)} for p in (got[1].fingerprint, got[2].fingerprint)]
    assert len(digests[0] & digests[1]) > 0.8 * len(digests[0])
    assert fingerprints.matched(docs([])).count() == 0
    plan = fingerprints.matched(docs(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
