"""Exact quantiles of many columns side by side.

Every pass over the table adds up one array of counters per range of values that holds a wanted rank, at first one range
a column. The range is cut at bounds that are partly evenly spaced and partly evenly many doubles apart, so that flat
values and long tails are both told apart, and a range of doubles of any kind ends after a few passes.
Ranges that hold a wanted rank are cut again while they are large; values are shuffled only from the last ones, counted
before. The driver holds ranges and bounds, whose number follows from the columns and probabilities alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of either kind that a column has in a pass.
PIECES = 4096
_SIGN = 1 << 63


@dataclass(frozen=True)
class Range:
    """Values of a column from ``low`` to ``high``, of which ``offset`` are smaller and ``count`` are inside."""

    column: int
    low: float
    high: float
    offset: int
    count: int


def _place(x: float) -> int:
    """A whole number for every double, in their order; neighbours differ by one."""
    bits = struct.unpack("<Q", struct.pack("<d", x))[0]
    return _SIGN - bits if bits >= _SIGN else bits


def _double(place: int) -> float:
    return struct.unpack("<d", struct.pack("<Q", _SIGN - place if place < 0 else place))[0]


def bounds(low: float, high: float, pieces: int) -> np.ndarray:
    """Where the pieces of a finite range begin, the first at ``low``."""
    even = np.linspace(low / 2, high / 2, pieces + 1) * 2
    first, last = _place(low), _place(high)
    apart = np.array([_double(first + (last - first) * i // pieces) for i in range(pieces + 1)])
    found = np.unique(np.concatenate([[low], even, apart]))
    return found[(found >= low) & (found <= high)]


def _inside(values: np.ndarray, r: Range) -> np.ndarray:
    return values[(values >= r.low) & (values <= r.high)]


def _counted(df: DataFrame, ranges: Sequence[Range], cuts: Sequence[np.ndarray]) -> DataFrame:
    """Rows (range, bucket, n): how many values lie between two bounds; one narrow pass, one array a range."""
    sent = df.sparkSession.sparkContext.broadcast(list(cuts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = sent.value
        counters = [np.zeros(len(c), np.int64) for c in cuts]
        for batch in batches:
            for r, c, n in zip(ranges, cuts, counters, strict=True):
                values = _inside(batch.column(r.column).to_numpy(zero_copy_only=False), r)
                n += np.bincount(np.searchsorted(c, values, "right") - 1, minlength=len(c))
        for i, n in enumerate(counters):
            some = np.flatnonzero(n)
            yield pa.record_batch({"range": pa.array(np.full(len(some), i, np.int32)), "bucket": pa.array(some.astype(np.int32)), "n": pa.array(n[some])})

    return df.mapInArrow(count, "range int, bucket int, n long").groupBy("range", "bucket").agg(F.sum("n").alias("n"))


def narrowed(df: DataFrame, ranges: Sequence[Range], ranks: Sequence[Sequence[int]]) -> list[Range]:
    """The pieces of ``ranges`` that hold one of the ``ranks`` of their column."""
    spark = df.sparkSession
    shares = [sum(r.column == other.column for other in ranges) for r in ranges]
    cuts = [bounds(r.low, r.high, max(64, PIECES // share)) for r, share in zip(ranges, shares, strict=True)]
    wanted = spark.createDataFrame(
        [(i, r.offset, [k for k in ranks[r.column] if r.offset <= k < r.offset + r.count]) for i, r in enumerate(ranges)],
        "range int, offset long, ranks array<long>",
    )
    running = Window.partitionBy("range").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Counters of a range are at most as many as its bounds.
    placed = _counted(df, ranges, cuts).withColumn("end", F.sum("n").over(running)).join(F.broadcast(wanted), "range")
    begin, end = F.col("offset") + F.col("end") - F.col("n"), F.col("offset") + F.col("end")
    hit = F.exists("ranks", lambda k: (k >= begin) & (k < end))
    out = []
    for row in placed.where(hit).select("range", "bucket", begin.alias("begin"), "n").collect():
        r, cut, at = ranges[row["range"]], cuts[row["range"]], row["bucket"]
        low = float(cut[at])
        high = r.high if at == len(cut) - 1 else float(np.nextafter(cut[at + 1], -np.inf))
        out.append(Range(r.column, low, high, row["begin"], row["n"]))
    return sorted(out, key=lambda r: (r.column, r.offset))


def values_inside(df: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """Rows (range, value, n): how often each value inside the ranges occurs."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, r in enumerate(ranges):
                values, n = np.unique(_inside(batch.column(r.column).to_numpy(zero_copy_only=False), r), return_counts=True)
                if len(values):
                    yield pa.record_batch({"range": pa.array(np.full(len(values), i, np.int32)), "value": pa.array(values), "n": pa.array(n.astype(np.int64))})

    return df.mapInArrow(gather, "range int, value double, n long").groupBy("range", "value").agg(F.sum("n").alias("n"))
