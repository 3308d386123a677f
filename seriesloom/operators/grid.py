"""Parameter grids as columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def float_range(start: float, stop: float, step: float) -> list[float]:
    """Values start, start + step, ... below ``stop``."""
    return [start + i * step for i in range(max(0, math.ceil((stop - start) / step)))]


def tie(error: Column) -> Column:
    """Errors that agree to seven digits are a tie: sums in another order move the last bits of a double."""
    return error.cast("float")


@dataclass(frozen=True)
class Grid:
    """The product of named value lists, numbered with the last name moving fastest.

    A grid is a small array column, worked out from the grid number. It is
    attached to each series by exploding it (or folding over it in place), so
    no series is ever joined with all others.
    """

    axes: Mapping[str, Sequence[float]]

    @property
    def size(self) -> int:
        return math.prod(len(v) for v in self.axes.values())

    def column(self) -> Column:
        """Array of structs (grid_id, one field per axis)."""
        strides, stride = {}, self.size
        for name, values in self.axes.items():
            stride //= len(values)
            strides[name] = stride

        def point(i: Column) -> Column:
            fields = [i.cast("int").alias("grid_id")]
            for name, values in self.axes.items():
                place = F.floor(i / F.lit(strides[name])).cast("int") % len(values)
                choices = F.array(*[F.lit(v) for v in values])
                fields.append(F.get(choices, place).alias(name))
            return F.struct(*fields)

        return F.transform(F.sequence(F.lit(0), F.lit(self.size - 1)), point)

    def arrays(self) -> dict[str, np.ndarray]:
        """The values of each axis at every grid point, in grid order."""
        mesh = np.meshgrid(*[np.asarray(v) for v in self.axes.values()], indexing="ij")
        return {name: m.ravel() for name, m in zip(self.axes, mesh)}

    def attach(self, series: DataFrame) -> DataFrame:
        """One row per (row of ``series``, grid point)."""
        return series.withColumn("_point", F.explode(self.column())).select(
            *series.columns, "_point.*"
        )


def pick_best(scored: DataFrame, keys: Sequence[str], metric: str, params: Sequence[str]) -> DataFrame:
    """Per series the parameters of the smallest metric; the first grid point wins a tie.

    ``status`` is "ok", or tells that no grid point had a number; the rest is then NULL.
    """
    usable = F.col(metric).isNotNull() & ~F.isnan(metric)
    order = F.when(usable, F.struct(tie(F.col(metric)), F.col("grid_id")))
    best = F.min_by(F.struct("grid_id", *params, metric), order)
    status = F.when(F.col("_best").isNull(), "no usable error").otherwise("ok").alias("status")
    return scored.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*", status)
