"""Joins that stay even when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one key that a single task may join.
ROWS_OF_A_KEY = 1_000_000


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, on: Sequence[str], rows_of_a_key: int | None = None) -> DataFrame:
    """Rows (on..., _ways): keys of more rows than a task should get, and into how many parts to split each.

    They are counted, and at most as many as there are shuffle partitions: any further key holds less than
    the average partition. Rows without a key don't count.
    """
    most, tasks = rows_of_a_key or ROWS_OF_A_KEY, _tasks(df.sparkSession)
    known = reduce(lambda a, c: a & F.col(c).isNotNull(), on, F.lit(True))
    counted = df.where(known).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    ways = F.least(F.ceil(F.col("_n") / most), F.lit(tasks)).cast("int").alias("_ways")
    found = counted.orderBy(F.desc("_n"), *on).limit(tasks).select(*on, ways).collect()
    schema = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in on), T.StructField("_ways", T.IntegerType())])
    return df.sparkSession.createDataFrame(found, schema)


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread: Column, how: str = "inner", hot: DataFrame | None = None
) -> DataFrame:
    """Inner or left join of many rows with few rows per key.

    Rows of a hot key go to as many tasks as their number asks for, by the hash of ``spread``, and only such keys' rows of
    the small side are repeated. ``hot`` are the keys, or their first columns, where they have been counted already
    (see :func:`hot_keys`). Rows without a key match nothing and go anywhere. Only ``hot`` is broadcast by hint.
    """
    if how not in ("inner", "left"):
        raise ValueError("the repeated side cannot be the outer one")
    hot = hot_keys(big, on) if hot is None else hot
    by = [c for c in hot.columns if c != "_ways"]
    unknown = reduce(lambda a, c: a | F.col(c).isNull(), on, F.lit(False))
    ways = F.when(unknown, F.lit(_tasks(big.sparkSession))).otherwise(F.coalesce(F.col("_ways"), F.lit(1)))
    left = big.join(F.broadcast(hot), by, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), ways).cast("int")).drop("_ways")
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_ways"), F.lit(1)) - 1)
    right = small.join(F.broadcast(hot), by, "left").withColumn("_salt", F.explode(parts)).drop("_ways")
    return left.join(right, on=[*on, "_salt"], how=how).drop("_salt")
