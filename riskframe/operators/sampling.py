"""Deterministic sampling, splitting and random-k selection.

``df.sample`` and ``randomSplit`` draw per partition, so a different file
layout or a task retried after an executor loss can pick different rows.
Here every row gets a pseudo-uniform number computed from its own key
(xxhash64 by default), so the choice depends only on the row. The same
sample comes out on any partitioning and after any retry. All three are
filters or TakeOrderedAndProject: no shuffle of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, col, unit_hash


def _u(keys: Sequence[ColumnOrName] | None, seed: int, by: Column | None) -> Column:
    if by is not None:
        return by
    if not keys:
        raise ValueError("give key columns (or a uniform column `by`)")
    return unit_hash(list(keys), seed)


def sample_rows(df: DataFrame, fraction: float, keys: Sequence[ColumnOrName] | None = None,
                seed: int = 42, by: Column | None = None) -> DataFrame:
    """Rows whose uniform value (from ``keys`` and ``seed``, or ``by``) is
    below ``fraction``; about ``fraction`` of the rows, the same on every run.

    With neither keys nor ``by``, falls back to Spark's Bernoulli
    ``sample(fraction, seed)``.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    if not keys and by is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(_u(keys, seed, by) < F.lit(fraction))


def split_bounds(weights: Sequence[float]) -> list[tuple[float, float]]:
    """Half-open [lo, hi) ranges of [0, 1) proportional to ``weights``."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    bounds, acc = [], 0.0
    for i, w in enumerate(weights):
        lo = acc
        acc = 1.0 if i == len(weights) - 1 else acc + w / total
        bounds.append((lo, acc))
    return bounds


def split_rows(df: DataFrame, weights: Sequence[float], keys: Sequence[ColumnOrName] | None = None,
               seed: int = 42, by: Column | None = None) -> list[DataFrame]:
    """Disjoint, exhaustive splits (e.g. 70/15/15) chosen by a per-row uniform value."""
    u = _u(keys, seed, by)
    return [df.filter((u >= F.lit(lo)) & (u < F.lit(hi))) for lo, hi in split_bounds(weights)]


def split_label(weights: Sequence[float], keys: Sequence[ColumnOrName] | None = None,
                seed: int = 42, by: Column | None = None) -> Column:
    """The split index (0-based) of each row as a column, for one-pass summaries."""
    u = _u(keys, seed, by)
    expr = None
    for i, (lo, hi) in enumerate(split_bounds(weights)):
        cond = (u >= F.lit(lo)) & (u < F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def random_k(df: DataFrame, k: int, keys: Sequence[ColumnOrName] | None = None,
             seed: int = 42, by: Column | None = None) -> DataFrame:
    """``k`` pseudo-random rows, repeatable: the rows with the smallest
    uniform value (ties by key). Plans as TakeOrderedAndProject, so each
    partition keeps only its own ``k`` candidates."""
    order = [_u(keys, seed, by)] + [col(k_) for k_ in (keys or [])]
    return df.orderBy(*order).limit(k)
