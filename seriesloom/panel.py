"""The panel: a long table of keyed series, one value per (keys, time)."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_SPREAD = "_null_spread"


#: Periods of which a calendar has few enough for one task to hold a series.
BOUNDED = ("day", "week", "month", "quarter", "year", "hour")


@dataclass(frozen=True)
class Panel:
    """Any number of series in one table.

    ``keys`` name a series, ``ts`` orders it, ``y`` is the measured value and a
    NULL in it is a missing observation. A panel holds one row per (keys, ts);
    with a DATE in ``ts`` a series is therefore never longer than the calendar,
    whatever the size of the raw table behind it. Timestamps have no such bound:
    see :mod:`seriesloom.operators.segments` for those.

    ``null_keys`` says whether key columns may be NULL. Such rows belong to no
    series: they are kept, but every per-series feature of theirs is NULL.
    ``bounded`` says that something other than a DATE bounds the length of a series.
    ``reach`` counts the rows that the features built so far look back, and ``base``
    those behind ``y`` itself, where it was built too.
    """

    df: DataFrame
    keys: tuple[str, ...]
    ts: str
    y: str
    null_keys: bool = True
    bounded: bool = False
    reach: float = 0
    base: float = 0

    def __post_init__(self) -> None:
        missing = [c for c in (*self.keys, self.ts, self.y) if c not in self.df.columns]
        if missing:
            raise ValueError(f"panel columns not in the table: {missing}")

    @classmethod
    def aggregate(
        cls,
        rows: DataFrame,
        keys: dict[str, str] | list[str],
        ts: str,
        measures: dict[str, Column],
        period: str = "day",
        ts_name: str = "ts",
        y: str | None = None,
    ) -> Panel:
        """Aggregate raw rows to one row per (keys, period).

        Partial aggregation on the map side shrinks a hot key to at most one row
        per period and task before anything is shuffled. Rows without a key are
        dropped, as a grouping by key does.
        """
        names = keys if isinstance(keys, dict) else {k: k for k in keys}
        if period == "day":
            moment = F.col(ts).cast("date")
        elif period in ("month", "quarter", "year", "week"):
            moment = F.trunc(F.col(ts), period)
        else:
            moment = F.date_trunc(period, F.col(ts))
        known = rows
        for source in names.values():
            known = known.where(F.col(source).isNotNull())
        df = known.groupBy(
            *[F.col(source).alias(name) for name, source in names.items()],
            moment.alias(ts_name),
        ).agg(*[expr.alias(name) for name, expr in measures.items()])
        return cls(df, tuple(names), ts_name, y or next(iter(measures)), null_keys=False, bounded=period in BOUNDED)

    def with_df(self, df: DataFrame) -> Panel:
        return replace(self, df=df)

    def measuring(self, y: str) -> Panel:
        # The new value may be any feature so far: what looks back from it looks further.
        return replace(self, y=y, base=self.reach)

    def looking_back(self, rows: float) -> Panel:
        """The panel after a feature that reads up to ``rows`` rows before each; infinite for whole series."""
        return replace(self, reach=max(self.reach, self.base + rows))

    @property
    def calendar_bound(self) -> bool:
        """True if the type of ``ts`` bounds the length of a series."""
        return isinstance(self.df.schema[self.ts].dataType, T.DateType)

    @property
    def has_key(self) -> Column:
        """Condition for rows that belong to a series."""
        present = F.lit(True)
        for key in self.keys:
            present = present & F.col(key).isNotNull()
        return present

    def spread_null_keys(self) -> Panel:
        """Give rows without a key a spreading column, so that no single task gets them all."""
        if not self.null_keys or NULL_SPREAD in self.df.columns:
            return self
        spread = F.when(~self.has_key, F.xxhash64(F.col(self.ts)))
        return self.with_df(self.df.withColumn(NULL_SPREAD, spread))

    def partition_columns(self) -> list[str]:
        extra = [NULL_SPREAD] if NULL_SPREAD in self.df.columns else []
        return [*self.keys, *extra]

    def window(self) -> WindowSpec:
        """The one ordered window all per-series operators share: one shuffle, one sort."""
        if not (self.bounded or self.calendar_bound):
            warnings.warn(
                "series of raw timestamps may outgrow one task: see operators.segments", stacklevel=3
            )
        return Window.partitionBy(*self.partition_columns()).orderBy(self.ts)

    def group_window(self) -> WindowSpec:
        """The same partitions without order: for totals over a series."""
        return Window.partitionBy(*self.partition_columns())

    def of_series(self, expr: Column) -> Column:
        """``expr`` on rows of a series, NULL on rows without a key."""
        return F.when(self.has_key, expr) if self.null_keys else expr

    def frame(self) -> DataFrame:
        """The table without helper columns."""
        return self.df.drop(NULL_SPREAD)
