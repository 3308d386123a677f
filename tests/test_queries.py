"""Every registered query against its SQL, or at least run, on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(spark, con, name):
    diff, _, _ = compare(spark, con, QUERIES[name], SQL[name], FOLDER)
    assert diff == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert {"priority", "mae", "smape"} <= set(df.columns)
    assert df.count() == 5


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
