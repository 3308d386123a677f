"""Least squares from sums of products.

For columns x0 to x(size-1) and a target w the sums ``s_i_j`` (i <= j), ``t_i`` and ``ww`` hold all that a regression needs,
and Spark adds them up before the shuffle. The small normal equations of many regressions are eliminated side by side in
:func:`solved`. The lists of steps say the same in SQL; a step is a list of (name, expression).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Steps = list[list[tuple[str, str]]]

#: A pivot below this share of its column's squares adds nothing.
SINGULAR = 1e-10


def products(size: int, x: str = "x", w: str = "w") -> dict[str, str]:
    """The sums of a regression on ``size`` columns, by name, as SQL; ``q_i`` are the columns' squares."""
    out = {f"s_{i}_{j}": f"sum({x}{i} * {x}{j})" for i in range(size) for j in range(i, size)}
    out |= {f"t_{i}": f"sum({x}{i} * {w})" for i in range(size)}
    return out | {f"q_{i}": f"sum({x}{i} * {x}{i})" for i in range(size)} | {"ww": f"sum({w} * {w})", "n": f"count({w})"}


def elimination(size: int, flags: Sequence[str] | None = None, nested: bool = False) -> Steps:
    """From the sums to pivots ``v_i`` (NULL where a column adds nothing) and the squared error ``ww``.

    ``flags`` are conditions under which each column is used at all. With ``nested``, ``ww_i`` is the error on the columns up to i.
    """
    steps: Steps = []
    for k in range(size):
        used = f"{flags[k]} AND " if flags else ""
        steps.append([(f"v_{k}", f"CASE WHEN {used}s_{k}_{k} > {SINGULAR} * q_{k} THEN s_{k}_{k} END")])
        step = [("ww", f"ww - coalesce(t_{k} * t_{k} / v_{k}, 0)")]
        for i in range(k + 1, size):
            step.append((f"t_{i}", f"t_{i} - coalesce(s_{k}_{i} * t_{k} / v_{k}, 0)"))
            step += [(f"s_{i}_{j}", f"s_{i}_{j} - coalesce(s_{k}_{i} * s_{k}_{j} / v_{k}, 0)") for j in range(i, size)]
        steps.append(step)
        if nested:
            steps.append([(f"ww_{k}", "ww")])
    return steps


def coefficients(size: int) -> Steps:
    """Back substitution after :func:`elimination`: ``b_i``, 0 where a column is not used."""
    steps: Steps = []
    for k in reversed(range(size)):
        rest = "".join(f" - s_{k}_{j} * b_{j}" for j in range(k + 1, size))
        steps.append([(f"b_{k}", f"coalesce((t_{k}{rest}) / v_{k}, 0)")])
    return steps


def inverse_diagonal(size: int) -> Steps:
    """After :func:`elimination`: ``i_k``, the diagonal of the normal matrix's inverse, 0 where a column is not used."""
    steps: Steps = []
    for k in range(size):
        terms = [f"1 / v_{k}"]
        for m in range(k + 1, size):
            # Column k of the inverse of the unit triangle, entry by entry.
            inner = "".join(f" - coalesce(s_{j}_{m} / v_{j}, 0) * y_{k}_{j}" for j in range(k + 1, m))
            steps.append([(f"y_{k}_{m}", f"0 - coalesce(s_{k}_{m} / v_{k}, 0){inner}")])
            terms.append(f"coalesce(y_{k}_{m} * y_{k}_{m} / v_{m}, 0)")
        steps.append([(f"i_{k}", f"coalesce({' + '.join(terms)}, 0)")])
    return steps


def in_sql(steps: Steps, source: str, name: str, known: Sequence[str] = ()) -> list[str]:
    """The same as a list of CTEs, from ``source`` to ``name``; ``known`` are columns that are there already."""
    ctes, have = [], set(known)
    for i, step in enumerate(steps):
        changed = [n for n, _ in step if n in have]
        have |= {n for n, _ in step}
        keep = f"* EXCLUDE ({', '.join(changed)})" if changed else "*"
        into = name if i == len(steps) - 1 else f"{name}_{i}"
        ctes.append(f"{into} AS (SELECT {keep}, {', '.join(f'{e} AS {n}' for n, e in step)} FROM {source if i == 0 else f'{name}_{i - 1}'})")
    return ctes


def summed(df: DataFrame, keys: Sequence[str], size: int, more: Mapping[str, Column] | None = None) -> DataFrame:
    """The sums of a regression per ``keys``; rows whose ``w`` is NULL don't count."""
    sums = [F.expr(e).alias(n) for n, e in products(size).items()]
    return df.groupBy(*keys).agg(*sums, *(c.alias(n) for n, c in (more or {}).items()))


def matrices(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sums of a batch as arrays: (rows, size, size), (rows, size) and (rows,); missing ones are NaN."""

    def column(name: str) -> np.ndarray:
        return batch.column(name).to_numpy(zero_copy_only=False).astype(float)

    s, t = np.zeros((batch.num_rows, size, size)), np.zeros((batch.num_rows, size))
    for i in range(size):
        t[:, i] = column(f"t_{i}")
        for j in range(i, size):
            s[:, i, j] = s[:, j, i] = column(f"s_{i}_{j}")
    return s, t, column("ww")


def solved(s: np.ndarray, t: np.ndarray, ww: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, squared error and the diagonal of the inverse, of one regression a row; 0 for columns not ``used``."""
    s, t, ww = s.copy(), t.copy(), ww.copy()
    size, squares = t.shape[1], np.einsum("nii->ni", s).copy()
    share = np.zeros_like(t)
    with np.errstate(invalid="ignore", divide="ignore"):
        for k in range(size):
            pivot = s[:, k, k]
            ok = used[:, k] & (pivot > SINGULAR * squares[:, k])
            row, target = s[:, k, k + 1 :].copy(), t[:, k].copy()
            share[:, k] = np.where(ok, 1 / pivot, 0)
            ww -= np.where(ok, target * target / pivot, 0)
            t[:, k + 1 :] -= np.where(ok[:, None], row * target[:, None] / pivot[:, None], 0)
            s[:, k + 1 :, k + 1 :] -= np.where(ok[:, None, None], row[:, :, None] * row[:, None, :] / pivot[:, None, None], 0)
    b, inverse = np.zeros_like(t), np.zeros_like(t)
    for k in reversed(range(size)):
        b[:, k] = np.where(share[:, k] > 0, (t[:, k] - np.einsum("nj,nj->n", s[:, k, k + 1 :], b[:, k + 1 :])) * share[:, k], 0)
    for k in range(size):
        y = np.zeros_like(t)
        y[:, k] = 1
        for m in range(k + 1, size):
            y[:, m] = -np.einsum("nj,nj->n", np.nan_to_num(s[:, k:m, m] * share[:, k:m]), y[:, k:m])
        inverse[:, k] = np.where(share[:, k] > 0, (y * y * share).sum(axis=1), 0)
    return b, ww, inverse
