import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))]


@pytest.fixture(scope="session")
def docs(spark):
    """Rows from (doc_id, text) pairs, in several partitions, with columns whose names might clash."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, key string, uid long")
        return df.repartition(parts)

    return make
