"""Aggregates and table profiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .quantiles import column_quantiles, quantiles_of_counts, value_counts
from .skew import salted_join

PROFILE_PROBS = (0.0, 0.05, 0.5, 0.95, 0.99, 1.0)
DESCRIBE_PROBS = (0.1, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99)


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if _is_number(f)]


def known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all known; grouping leaves out the others."""
    return reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df)


def total(y: str | Column) -> Column:
    """Sum that is zero, not NULL, where nothing is known."""
    return F.coalesce(F.sum(y), F.lit(0).cast("double"))


def statistics(y: str, which: Sequence[str], prefix: str | None = None) -> dict[str, Column]:
    """Named aggregates of one column; ``prefix`` goes before each name.

    The median here is Spark's own and keeps the distinct values of a group in
    memory: use it on groups a calendar bounds, and ``exact_quantiles`` elsewhere.
    """
    known = {
        "sum": total(y),
        "mean": F.avg(y),
        "median": F.median(y),
        "std": F.stddev_samp(y),
        "min": F.min(y),
        "max": F.max(y),
        "count": F.count(y),
        "nunique": F.count_distinct(y),
    }
    lead = f"{prefix}_" if prefix else ""
    return {f"{lead}{s}": known[s] for s in which}


def group_statistics(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Statistics of several columns per group; outputs are named column_statistic."""
    aggs = {}
    for y, which in measures.items():
        aggs |= statistics(y, which, y)
    return known_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def null_counts(df: DataFrame) -> DataFrame:
    """Rows (column_name, n_missing). One pass, one row, then turned to long form."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def missing(c: str) -> Column:
        gone = F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull()
        return F.coalesce(F.sum(gone.cast("long")), F.lit(0)).cast("long").alias(c)

    one_row = df.agg(*[missing(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_missing")) for c in df.columns]
    )
    return one_row.select(F.explode(pairs).alias("_p")).select("_p.*")


def quantile_label(p: float) -> str:
    """A probability as a column name: 0.05 becomes q0_05."""
    return "q" + f"{p:g}".replace(".", "_")


def quantile_table(df: DataFrame, probs: Sequence[float] = PROFILE_PROBS) -> DataFrame:
    """One row per numeric column, one column per quantile."""
    long = column_quantiles(df, numeric_columns(df), probs)
    return long.groupBy(F.col("column").alias("column_name")).agg(
        *[F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(quantile_label(p)) for p in probs]
    )


def describe_column(df: DataFrame, y: str, probs: Sequence[float] = DESCRIBE_PROBS) -> DataFrame:
    """Rows (stat, value): count, mean, std, min, quantiles and max of one column."""
    probs = sorted({*probs, 0.5})
    v = F.col(y).cast("double")
    basic = {
        "count": F.count(v).cast("double"),
        "mean": F.avg(v),
        "std": F.stddev_samp(v),
        "min": F.min(v),
        "max": F.max(v),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("stat"), F.col(n).alias("value")) for n in basic])
    label = F.concat((F.col("prob") * 100).cast("decimal(9,4)").cast("double").cast("int").cast("string"), F.lit("%"))
    quantiles = column_quantiles(df, [y], probs).select(label.alias("stat"), "value")
    return df.agg(*[e.alias(n) for n, e in basic.items()]).select(F.inline(rows)).unionByName(quantiles)


def profile(df: DataFrame, order: Sequence[str], head: int = 5) -> DataFrame:
    """A table's shape, types, first and last rows, missing counts and quantiles.

    Tidy rows (section, column_name, stat, value, text): numbers are in ``value``,
    everything else in ``text``. Which rows come first is set by ``order``.
    """
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def entry(section: str, column: Column, stat: Column, value: Column, text: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            column.alias("column_name"),
            stat.alias("stat"),
            value.cast("double").alias("value"),
            text.cast("string").alias("text"),
        )

    no_value, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    # Shape, types and missing counts come from one pass.
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count(F.nanvl(c, F.lit(None).cast("double")) if c in floating else c).alias(f"_known_{i}")
            for i, c in enumerate(df.columns)
        ],
    )
    facts = [
        entry("shape", no_text, F.lit("rows"), F.col("_rows"), no_text),
        entry("shape", no_text, F.lit("columns"), F.lit(len(df.columns)), no_text),
    ]
    for i, c in enumerate(df.columns):
        facts += [
            entry("types", F.lit(c), F.lit("dtype"), no_value, F.lit(spark_types[c])),
            entry("missing", F.lit(c), F.lit("n_missing"), F.col("_rows") - F.col(f"_known_{i}"), no_text),
            entry("missing", F.lit(c), F.lit("n_known"), F.col(f"_known_{i}"), no_text),
        ]
    parts = [counted.select(F.explode(F.array(*facts)).alias("_e"))]

    for section, rows in (("head", head_rows(df, order, head)), ("tail", tail_rows(df, order, head))):
        cells = [
            entry(
                section,
                F.lit(f.name),
                F.concat(F.lit("row "), F.col("_place").cast("string")),
                F.col(f.name) if _is_number(f) else no_value,
                no_text if _is_number(f) else F.col(f.name),
            )
            for f in df.schema.fields
        ]
        parts.append(rows.select(F.explode(F.array(*cells)).alias("_e")))

    quantiles = column_quantiles(df, numeric_columns(df), PROFILE_PROBS)
    parts.append(
        quantiles.select(
            entry("quantiles", F.col("column"), F.col("prob").cast("string"), F.col("value"), no_text).alias("_e")
        )
    )
    return reduce(DataFrame.unionByName, parts).select("_e.*")


def _placed(rows: DataFrame, order: Sequence[str], ascending: bool) -> DataFrame:
    # At most a handful of rows are left here, so one window over all of them is fine.
    by = [F.col(c).asc() if ascending else F.col(c).desc() for c in order]
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*by)))


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows with their place: a top-n, not a full sort."""
    return _placed(df.orderBy(*order).limit(n), order, True)


def tail_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows; place 1 is the last one."""
    by = [F.col(c).desc() for c in order]
    return _placed(df.orderBy(*by).limit(n), order, False)


def box_statistics(df: DataFrame, by: Sequence[str], y: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count per group: the numbers behind a box plot.

    Whiskers end at the outermost values within ``reach`` interquartile ranges of
    the box. Values are counted before anything else, so a large group is spread
    over many tasks throughout.
    """
    counts = cut_lineage(value_counts(df, [y], by))
    long = quantiles_of_counts(counts, (0.25, 0.5, 0.75), by)
    boxes = long.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )
    v, n = F.col("value"), F.col("n")
    iqr = F.col("q3") - F.col("q1")
    inside = (v >= F.col("q1") - reach * iqr) & (v <= F.col("q3") + reach * iqr)
    return (
        salted_join(counts, boxes, by, v)
        .groupBy(*by)
        .agg(
            F.sum(n).alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(n)).cast("long").alias("n_outliers"),
        )
    )


#: Most address bits of Spark's distinct-count sketch.
SKETCH_BITS = 18


def _sketch(limit: int) -> tuple[float, float] | None:
    """Precision of a distinct-count sketch for a limit, and the largest estimate that many values can lead to.

    The estimate counts empty registers: d values fill at most d of m registers,
    and the estimate m*ln(m/empty) only grows with the number filled. None if no
    sketch has registers enough.
    """
    bits = max(12, math.ceil(math.log2(4 * max(limit, 1))))
    if bits > SKETCH_BITS:
        return None
    registers = 2**bits
    return 1.106 / math.sqrt(registers) * (1 + 1e-9), registers * math.log(registers / (registers - limit))


def classify_columns(df: DataFrame, few: int = 10, many: int = 20) -> DataFrame:
    """Rows (column_name, dtype, class): categorical, numeric or cardinal.

    Text columns are categorical, or cardinal with more than ``many`` distinct
    values. Other columns are numeric, or categorical with fewer than ``few``.

    Distinct counts are needed only up to ``many``. A first pass keeps a small
    sketch per column; an estimate above what ``many`` values can lead to proves
    the column above the limit. Only the other columns, which have few values,
    are counted exactly, reading nothing else. NaN counts as missing.
    """
    limit = max(few, many)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])
    unclear, sketch = df.columns, _sketch(limit)
    if sketch:
        precision, bound = sketch
        estimates = df.agg(*[F.approx_count_distinct(c, precision).alias(c) for c in df.columns]).first()
        unclear = [c for c in df.columns if estimates[c] <= math.ceil(bound)]
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def class_of(c: str, distinct: Column) -> Column:
        if c in text:
            return F.when(distinct > many, F.lit("cardinal")).otherwise(F.lit("categorical"))
        return F.when(distinct < few, F.lit("categorical")).otherwise(F.lit("numeric"))

    types = dict(df.dtypes)

    def row(c: str, distinct: Column) -> Column:
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"), class_of(c, distinct).alias("class")
        )

    # Values of the unclear columns are made distinct per column before they are counted.
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in unclear or df.columns[:1]]
    )
    distinct = (
        df.select(F.explode(pairs).alias("_p")).select("_p.*").where(F.col("v").isNotNull()).distinct()
    )
    counted = distinct.agg(
        F.count(F.lit(1)).alias("_values"),
        *[F.count(F.when(F.col("c") == c, 1)).alias(c) for c in unclear],
    )
    rows = [row(c, F.col(c) if c in unclear else F.lit(limit + 1)) for c in df.columns]
    return counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
