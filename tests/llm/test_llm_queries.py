"""The registered queries against their SQL, and the pipeline's stages against plain rules."""

from collections import Counter

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from seriesloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equals_sql(spark, name):
    diff, _, _ = compare(spark, connect(FOLDER), queries.QUERIES[name], queries.ORACLES[name], FOLDER)
    assert diff == ""


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, FOLDER).cache()
    assert good.columns == docs.columns
    verdict = {r.doc_id: r.kept for r in queries.QUERIES["op9_quality"](spark, FOLDER).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, k in verdict.items() if k}
    # Repeated rows and a missing id go through all stages.
    odd = good.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    good = good.union(good.limit(3)).union(odd).union(odd).cache()
    unique = stages["near duplicates"](spark, good, FOLDER).cache()
    assert unique.columns == docs.columns
    words = {r.doc_id: tuple(r.text.lower().split()) for r in unique.collect()}
    assert len(words) == unique.count() and len(set(words.values())) == len(words)
    mixed = stages["mixing"](spark, unique, FOLDER).cache()
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) == set(words) and max(times.values()) <= 2
    pieces = stages["packing"](spark, mixed, FOLDER).collect()
    whole = {r.doc_id: r.doc_tokens for r in pieces}
    assert sum(r.length for r in pieces) == sum(whole[i] * n for i, n in times.items())


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and rows.count() > 0
