"""The quality classifier: vectors against a plain count, labels it may not see, and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import ROWS

from seriesloom.llm import classifier

PARTS = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+|[!-/:-@\[-`{-~\x0e-\x1f\x7f]+")


def hashes(text):
    """Words of one text with their hashes, as the module finds them."""
    ((_, words, _),) = classifier.runs([text])
    return words


def test_words_are_runs_of_letters_or_signs():
    text = "Don't  stop!!now…\n\x0bé%%%é a.b"
    parts = PARTS.findall(text)
    assert parts == ["Don", "'", "t", "stop", "!!", "now…", "é", "%%%", "é", "a", ".", "b"]
    whole = hashes(text)
    assert len(whole) == len(parts) and all(hashes(p)[0] == h for p, h in zip(parts, whole, strict=True))


def table_of(texts):
    """Context sums word by word."""
    out = np.zeros((classifier.BUCKETS, classifier.DIMENSIONS + 1))
    for text in texts:
        words = hashes(text) if PARTS.findall(text or "") else np.zeros(0, np.uint64)
        row, (place, sign) = classifier.buckets(words), classifier.index_vectors(words)
        for i in range(len(words)):
            out[row[i], -1] += 1
            for j in range(max(0, i - classifier.REACH), min(len(words), i + classifier.REACH + 1)):
                if j != i:
                    for s in range(classifier.SIGNS):
                        out[row[i], place[s, j]] += sign[s, j]
    return out


def test_context_table(docs):
    rows = [r for r in ROWS if len(r[1] or "") < 3000]
    assert (classifier.context_table(docs(rows, 4)) == table_of([t for _, t in rows])).all()


def test_pooling_and_chunks(monkeypatch):
    vectors = np.random.default_rng(1).integers(-1024, 1025, (classifier.BUCKETS, classifier.DIMENSIONS)).astype(np.int32)
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(99)}" for _ in range(r.randrange(0, 40))) for _ in range(30)] + ["", None, "one"]
    ((_, words, ends),) = classifier.runs(texts)
    whole = classifier.pooled(vectors, words, ends)
    for size in (1, 7, 64):
        monkeypatch.setattr(classifier, "_CHUNK", size)
        assert (classifier.pooled(vectors, words, ends) == whole).all()
    for x, a, z in zip(whole, [0, *ends[:-1]], ends, strict=True):
        v = vectors[classifier.buckets(words[a:z])] / classifier.ONE
        want = [v.mean(0), v.std(0), np.abs(np.diff(v, axis=0)).mean(0) if len(v) > 1 else 0 * v[0]] if len(v) else [np.zeros(classifier.DIMENSIONS)] * 3
        assert np.allclose(x, np.concatenate(want), atol=1e-6)


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(0)
    margin = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-margin))).astype(int)
    assert abs(classifier.temperature(5 * margin, y) - 5) < 0.3


def made(spark, n=1500):
    r = random.Random(3)
    good, bad = [f"fine{i}" for i in range(60)], [f"poor{i}" for i in range(60)]
    rows = []
    for i in range(n):
        q = r.randrange(2)
        words = [r.choice(good if q else bad) if r.random() < 0.5 else f"w{r.randrange(2000)}" for _ in range(r.randrange(5, 60))]
        rows.append((i, " ".join(words), q))
    return rows


def test_held_out_accuracy_and_no_leak(spark, docs):
    rows = made(spark)
    table = docs([(i, t) for i, t, _ in rows])
    fold = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    labels = spark.createDataFrame([(i, q, "en") for i, _, q in rows], "doc_id long, quality int, lang string")
    got = {r.doc_id: r for r in classifier.scored(table, labels).collect()}
    assert {i: r.held_out for i, r in got.items()} == fold
    kept = [(got[i].score, q) for i, _, q in rows if fold[i]]
    assert sum((s > 0.5) == q for s, q in kept) / len(kept) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    # Labels of the held-out fold, whatever they say, change nothing.
    other = spark.createDataFrame([(i, 1 - q if fold[i] else q, "en") for i, _, q in rows], "doc_id long, quality int, lang string")
    again = {r.doc_id: r.score for r in classifier.scored(table, other).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_defined_cases(spark, docs):
    labels = spark.createDataFrame([(7, 1), (12, 0), (4, 1), (13, 0), (5, None), (6, 9), (None, 0), (7, 1), (8, 1), (9, 0)], "doc_id long, quality int")
    got = classifier.scored(docs(ROWS), labels)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    # Empty texts share the score of a vector of zeros; repeated rows score alike.
    assert by[1] == by[2] == by[3] and all(len(s) == 1 for s in by.values())
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert classifier.scored(docs(ROWS[:0]).where("false"), labels).count() == 0


@pytest.mark.parametrize("kept,score", [("quality = 1", 1.0), ("false", 0.5)])
def test_labels_of_one_kind(spark, docs, kept, score):
    labels = spark.createDataFrame([(7, 1), (8, 1), (9, 0)], "doc_id long, quality int").where(kept)
    assert {r.score for r in classifier.scored(docs(ROWS), labels).collect()} == {score}


def test_query_on_held_out_rows(spark):
    from seriesloom.llm import queries

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = queries.QUERIES["op13_classifier"](spark, folder).join(labels, "doc_id").where("held_out").select("predicted", F.col("quality").alias("q")).collect()
    assert len(rows) > 50 and sum(r.predicted == r.q for r in rows) / len(rows) > 0.9
