import random
import textwrap

from samples import ROWS, words

from seriesloom.llm import licenses


def dice(a, b):
    x, y = (licenses.bigrams(licenses.normalised(t)) for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def brute(text):
    lines = (text or "").split("\n")
    passages = [*enumerate(lines, 1), *([(0, text)] if len(lines) > 1 else [])]
    hits = {}
    for place, p in passages:
        for i, (name, t) in enumerate(licenses.TEMPLATES):
            if dice(p, t) >= licenses.LEAST / 100:
                hits[place or 10**9, i] = (-dice(p, t), place or 10**9, i, name)
    best = min(hits.values(), default=None)
    return len({p for p, _ in hits}), best and best[3], best and -best[0], best and best[1] % 10**9


def test_equals_comparing_all_templates(docs):
    mit, apache = licenses.TEMPLATES[2][1], licenses.TEMPLATES[1][1]
    rows = [*ROWS, (40, words(50, 1) + "\n" + mit.upper() + "\n" + words(9, 2)), (41, apache), (42, apache.replace("file", "thing") + "\n" + mit), (43, "Licensed   under—CC BY 4.0!"), (44, "\n" + mit)]
    got = sorted(((r.doc_id, r.n_notices, r.license, r.dice, r.passage) for r in licenses.scan(docs(rows)).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert sum(r[1] > 0 for r in got) == 5


def test_size_bounds_drop_no_match():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for n in range(1, 80):
        near = {i for _, i, _, _ in scanner.candidates(n)}
        for i, (_, t) in enumerate(licenses.TEMPLATES):
            m = len(licenses.bigrams(licenses.normalised(t)))
            if 200 * min(n, m) >= licenses.LEAST * (n + m):
                assert i in near


def best_run(text, template):
    w = licenses.normalised(text)
    return max((dice(" ".join(w[a:b]), template) for a in range(len(w)) for b in range(a + 2, len(w) + 1)), default=0)


def test_wrapped_and_embedded_notices(docs):
    gpl, mit = licenses.TEMPLATES[5][1], next(t for n, t in licenses.FULL if n == "MIT")
    whole_gpl = max((t for n, t in licenses.FULL if n == "GPL-3.0"), key=len)
    wrapped = "\n# ".join(textwrap.wrap(gpl, 60))
    cc = "Photo by Jane Doe from the city archive. Licensed under CC BY 4.0."
    rows = [
        (1, words(300, 1) + "\n" + wrapped + "\n" + words(300, 2)),
        (2, cc),
        (3, mit),
        (4, words(50, 3) + "\n" + whole_gpl + "\n" + words(50, 4)),
        (5, words(40, 5) + " " + cc + " " + words(40, 6) + " Released under the\nMIT License. " + words(40, 7)),
        (6, "released under the mit " * 3000 + words(20, 9)),
        (7, words(500, 8)),
    ]
    got = {r.doc_id: (r.n_notices, r.license, r.dice, r.passage) for r in licenses.scan(docs(rows)).collect()}
    assert got[1] == (1, "GPL-3.0", 1.0, 2)
    assert got[2] == (1, "CC-BY-4.0", 1.0, 1)
    assert got[3] == (1, "MIT", 1.0, 1)
    assert got[4] == (1, "GPL-3.0", 1.0, 2)
    assert got[5] == (2, "MIT", 1.0, 1)  # of equal scores on one line the template named first
    assert got[6] == (3000, "MIT", 6 / 7, 1)
    assert got[7] == (0, None, None, None)


def test_runs_reach_the_best_score():
    r = random.Random(3)
    for k in (0, 2, 8):
        name, template = licenses.TEMPLATES[k]
        runs = licenses.Runs([(name, template)])
        for _ in range(60):
            w = licenses.normalised(template)
            for _ in range(r.randrange(4)):
                w.insert(r.randrange(len(w) + 1), r.choice([*w, "x"]))
            text = " ".join(["a", "b", *w, "c", "d"][r.randrange(4) :])
            own = licenses.normalised(text)
            found = runs.found(own, licenses.bigrams(own), [])
            assert bool(found) == (best_run(text, template) >= licenses.LEAST / 100)
            for c, score, first, last, _ in found:
                assert score == dice(" ".join(own[first : last + 2]), template) and c == len(licenses.bigrams(own[first : last + 2]) & licenses.bigrams(licenses.normalised(template)))


def test_empty_table(docs):
    assert licenses.scan(docs([])).count() == 0


def test_all_notices_are_listed(docs):
    mit, cc = licenses.TEMPLATES[2][1], "Licensed under CC BY 4.0."
    rows = [(1, words(30, 1) + "\n" + cc + "\n" + words(30, 2) + "\n" + mit + "\n" + cc), (2, words(30, 3))]
    got = {r.doc_id: r for r in licenses.scan(docs(rows)).collect()}
    assert [(n.license, n.passage) for n in got[1].notices] == [("CC-BY-4.0", 2), (licenses.TEMPLATES[2][0], 4), ("CC-BY-4.0", 5)]
    assert got[1].n_notices == 3 and min(n.dice for n in got[1].notices) >= licenses.LEAST / 100
    assert got[2].notices == []
