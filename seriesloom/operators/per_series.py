"""Functions of one whole series, run on Arrow batches of many series."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..panel import Panel


def map_series(
    arrays: DataFrame, fn: Callable[..., list[dict]], inputs: Sequence[str], keep: Sequence[str], output: str
) -> DataFrame:
    """Call ``fn`` with the ``inputs`` of each row; its dicts become rows beside ``keep``.

    An exception in one series does not end the job: that row comes back with
    NULL results and the message in ``status``, which is "ok" everywhere else.
    """
    fields = T._parse_datatype_string(output).fields
    schema = T.StructType(
        [arrays.schema[c] for c in keep] + fields + [T.StructField("status", T.StringType())]
    )
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                kept = [record[c] for c in keep]
                try:
                    for found in fn(*[record[c] for c in inputs]):
                        rows.append([*kept, *[found.get(n) for n in names], "ok"])
                except Exception as e:  # one bad fit is a row, not a failed job
                    rows.append([*kept, *[None] * len(names), f"{type(e).__name__}: {e}"])
            yield pd.DataFrame(rows, columns=schema.names)

    return arrays.mapInPandas(run, schema)


def transform_series(panel: Panel, fn: Callable[[pd.Series], pd.Series], into: str) -> Panel:
    """Any function from an ordered series to one of the same length.

    The open form, for what the native window operators do not offer. A series
    has to fit in one task, so the time column must be a DATE, whose calendar
    bounds its length. Rows without a key come back with NULL.
    """
    if not panel.calendar_bound:
        raise TypeError("a series-at-a-time function needs a DATE time column")
    df = panel.df.where(panel.has_key) if panel.null_keys else panel.df
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.DoubleType())])
    ts, y = panel.ts, panel.y

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(ts, ignore_index=True)
        ordered[into] = fn(ordered[y]).to_numpy(dtype="float64")
        return ordered

    done = df.groupBy(*panel.keys).applyInPandas(run, schema)
    if panel.null_keys:
        rest = panel.df.where(~panel.has_key).withColumn(into, F.lit(None).cast("double"))
        done = done.unionByName(rest)
    return panel.with_df(done)
