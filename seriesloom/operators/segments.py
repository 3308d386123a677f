"""Window features of series with no bound on their length.

A daily or monthly series fits in one task: its calendar bounds it. A series of
timestamps does not have to, and one key may hold a third of the table. Here the
rows are range-partitioned by (keys, order), which splits a long series wherever
it has to, and numbered by adding up the sizes of the pieces. The numbered rows
are then cut into chunks of fixed size, and each chunk gets the last ``reach``
rows of the one before it. Any feature that looks back at most ``reach`` rows
comes out the same as over the whole series; the operators say how far they look.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..panel import Panel
from ..session import cut_lineage

PLACE, PIECE, CHUNK, BORROWED = "_place", "_piece", "_chunk", "_borrowed"


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None) -> DataFrame:
    """Append the position of each row in its series (from 1) and the piece it lies in.

    ``order`` must tell all rows of a key apart. The pieces are written out before
    they are counted: a task run again after a lost executor must not cut the
    series elsewhere.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = cut_lineage(
        df.repartitionByRange(pieces, *keys, *order).withColumn(PIECE, F.spark_partition_id())
    )
    by_piece = Window.partitionBy(*keys, PIECE)
    placed = cut.withColumn(PLACE, F.row_number().over(by_piece.orderBy(*order)).cast("long"))
    # One row per key and piece: a key never has more rows here than there are pieces.
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, PIECE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return (
        placed.join(offsets, on=[*keys, PIECE])
        .withColumn(PLACE, F.col(PLACE) + F.col("_offset"))
        .drop("_offset")
    )


def over_segments(
    panel: Panel,
    features: Callable[[Panel], Panel],
    reach: int | None = None,
    tie_break: Sequence[str] = (),
    rows: int = 200_000,
    pieces: int | None = None,
) -> DataFrame:
    """Apply panel operators that look back a bounded number of rows, chunk by chunk.

    ``features`` gets a panel whose series are the chunks. Its operators report how far
    they look back (:meth:`Panel.looking_back`; functions of a user's own must do so
    too). ``reach`` is what they report, or more where it is given; less is an error,
    and so are operators that look at whole series (fills, first rows, exponential
    means, which carry a mean across gaps of any length). Rows without a key come back
    with NULL features.
    """
    if (reach or 0) < 0 or rows < 1:
        raise ValueError("reach and rows must not be negative")
    keyed = panel.df.where(panel.has_key)
    needed = features(_of_chunks(panel, keyed.withColumns({CHUNK: F.lit(0).cast("long"), PLACE: F.lit(1).cast("long"), BORROWED: F.lit(False)}))).reach
    if math.isinf(needed):
        raise ValueError("features that look at whole series cannot be built chunk by chunk")
    if reach is not None and reach < needed:
        raise ValueError(f"the features look back {int(needed)} rows, more than the reach of {reach}")
    reach = int(needed) if reach is None else reach
    rows = max(rows, reach, 1)
    placed = number_rows(keyed, panel.keys, [panel.ts, *tie_break], pieces)
    at = F.col(PLACE) - 1
    own = F.struct(F.floor(at / rows).alias("chunk"), F.lit(False).alias("borrowed"))
    lent = F.struct((F.floor(at / rows) + 1).alias("chunk"), F.lit(True).alias("borrowed"))
    copies = F.when(at % rows >= rows - reach, F.array(own, lent)).otherwise(F.array(own))
    chunks = placed.withColumn("_copy", F.explode(copies)).withColumns(
        {CHUNK: F.col("_copy.chunk"), BORROWED: F.col("_copy.borrowed")}
    )
    done = features(_of_chunks(panel, chunks.drop("_copy", PIECE))).frame().where(~F.col(BORROWED)).drop(CHUNK, BORROWED, PLACE)
    if not panel.null_keys:
        return done
    return done.unionByName(panel.df.where(~panel.has_key), allowMissingColumns=True)


def _of_chunks(panel: Panel, df: DataFrame) -> Panel:
    """A panel whose series are the chunks."""
    return Panel(df, (*panel.keys, CHUNK), PLACE, panel.y, null_keys=False, bounded=True)


def backward_fill_long(
    panel: Panel, into: str, tie_break: Sequence[str] = (), pieces: int | None = None
) -> DataFrame:
    """Next known value of a series of any length, whatever the length of its gaps.

    Each piece fills itself; what is open at its end takes the first known value
    of a later piece, looked up in a table of one row per piece.
    """
    y = F.col(panel.y)
    placed = number_rows(panel.df.where(panel.has_key), panel.keys, [panel.ts, *tie_break], pieces)
    seen = (
        Window.partitionBy(*panel.keys, PIECE)
        .orderBy(F.col(PLACE).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    later = (
        Window.partitionBy(*panel.keys)
        .orderBy(F.col(PIECE).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first_known = (
        placed.groupBy(*panel.keys, PIECE)
        .agg(F.min_by(y, F.when(y.isNotNull(), F.col(PLACE))).alias("_first"))
        .withColumn("_next", F.last("_first", ignorenulls=True).over(later))
        .drop("_first")
    )
    own = placed.withColumn("_own", F.last(y, ignorenulls=True).over(seen))
    filled = own.join(first_known, on=[*panel.keys, PIECE]).withColumn(into, F.coalesce("_own", "_next"))
    done = filled.drop("_own", "_next", PIECE, PLACE)
    if not panel.null_keys:
        return done
    return done.unionByName(panel.df.where(~panel.has_key).withColumn(into, y))
