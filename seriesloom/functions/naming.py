"""Names of derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def alpha_text(alpha: float) -> str:
    """A smoothing weight as part of a column name: 0.95 becomes 095."""
    return "".join(ch for ch in str(alpha) if ch != ".")


def lag_name(y: str, lag: int) -> str:
    return f"{y}_lag_{lag}"


def roll_name(y: str, window: int) -> str:
    return f"{y}_roll_mean_{window}"


def ewm_name(y: str, alpha: float, lag: int) -> str:
    return f"{y}_ewm_alpha_{alpha_text(alpha)}_lag_{lag}"


def replace_in_names(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace a piece of text in every column name."""
    renames = {c: c.replace(old, new) for c in df.columns if old in c}
    if len(set(renames.values()) | (set(df.columns) - set(renames))) != len(df.columns):
        raise ValueError(f"renaming {old!r} to {new!r} would make two columns of one name")
    return df.withColumnsRenamed(renames)
