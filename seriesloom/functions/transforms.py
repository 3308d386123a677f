"""Value transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_log(y: Column) -> Column:
    """log(1 + y); missing stays missing."""
    return F.log1p(y)


def from_log(z: Column) -> Column:
    """Inverse of :func:`to_log`."""
    return F.expm1(z)


def noise(sd: float, seed: int) -> Column:
    """One Gaussian draw per row. Repeatable only for an unchanged plan and partitioning."""
    return F.randn(seed) * F.lit(float(sd))
