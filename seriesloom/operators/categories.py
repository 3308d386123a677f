"""Codes and sparse indicators for category columns with any number of values.

``one_hot`` in :mod:`seriesloom.operators.combine` makes a column of every value and suits a few hundred of them. Here the
values are numbered by a sort over all tasks, the numbers are joined to the rows, and the indicators of a row become
one sparse vector, as wide as there are values and as long as there are columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import salted_join

WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Bits of a row's number within its partition in ``monotonically_increasing_id``.
ROW_BITS = 33


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value, code): the distinct known values of each column, numbered from 0 in order.

    Values are text; whole numbers are ordered as numbers. The table is written out, and nothing of it passes the driver.
    """
    types = dict(df.dtypes)

    def pair(i: int, c: str):
        number = F.col(c).cast("bigint") if types[c] in WHOLE else F.lit(None).cast("bigint")
        return F.struct(F.lit(i).alias("_i"), number.alias("_number"), F.col(c).cast("string").alias("value"))

    order = ["_i", "_number", "value"]
    values = df.select(F.explode(F.array(*(pair(i, c) for i, c in enumerate(columns)))).alias("_p")).select("_p.*")
    ranged = values.where(F.col("value").isNotNull()).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)
    placed = cut_lineage(ranged.withColumns({"_part": F.spark_partition_id(), "_at": at}))
    # A row per column and range: columns are few, and ranges as many as shuffle partitions.
    sizes = placed.groupBy("_i", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_i").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    name = F.element_at(F.array(*(F.lit(c) for c in columns)), F.col("_i") + 1)
    return placed.join(F.broadcast(starts), ["_i", "_part"]).select(name.alias("column"), "value", (F.col("_start") + F.col("_at")).alias("code"))


def coded(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None) -> DataFrame:
    """``df`` with ``<column>__code`` for each column: NULL where the value is missing or not in the index.

    Pass the ``index`` of a training table to give another table the same codes. Values that many rows share are
    split among tasks.
    """
    index = category_index(df, columns) if index is None else index
    for c in columns:
        mine = index.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"{c}__code"))
        spread = F.xxhash64(*df.columns)
        df = salted_join(df.withColumn("_value", F.col(c).cast("string")), mine, ["_value"], spread, "left").drop("_value")
    return df


def sparse_one_hot(df: DataFrame, columns: Sequence[str], index: DataFrame | None = None, into: str = "indicators") -> DataFrame:
    """``df`` with one sparse vector of 0/1 indicators, those of the first column first, each in value order.

    A missing or unknown value sets no indicator. Linear models take such vectors as they are; Spark's trees make
    every row dense, so that they want the codes or a hash of many values instead.
    """
    index = category_index(df, columns) if index is None else index
    found = {r["column"]: r["size"] for r in index.groupBy("column").agg(F.count(F.lit(1)).alias("size")).collect()}
    used = [c for c in columns if c in found]
    if not used:
        raise ValueError(f"no known value in {list(columns)}")
    out = coded(df, used, index)
    # A number past the last value stands for none: the encoder leaves it out.
    places = {f"_place_{i}": F.coalesce(F.col(f"{c}__code"), F.lit(found[c])).cast("double") for i, c in enumerate(used)}
    vectors = [f"_vector_{i}" for i in range(len(used))]
    widest = df.sparkSession.createDataFrame([tuple(float(found[c] - 1) for c in used)], ", ".join(f"{p} double" for p in places))
    encoder = OneHotEncoder(inputCols=[*places], outputCols=vectors, handleInvalid="keep", dropLast=True).fit(widest)
    rows = encoder.transform(out.withColumns(places))
    rows = VectorAssembler(inputCols=vectors, outputCol=into).transform(rows)
    return rows.drop(*places, *vectors, *(f"{c}__code" for c in used if f"{c}__code" not in df.columns))
