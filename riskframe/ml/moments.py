"""Linear regression from one pass of moments.

One aggregate computes the means and centred cross products of the features and the target; the normal equations of any subset of the features
are then solved from that small matrix, without another scan. Only (k + 1) x (k + 2) / 2 numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import number_of


@dataclass(frozen=True)
class Moments:
    """Number of complete rows, means and covariances (divisor n) of the named columns."""

    names: tuple[str, ...]
    n: int
    means: np.ndarray
    covariances: np.ndarray


@dataclass(frozen=True)
class LinearFit:
    """``target`` = intercept + sum of coefficients x features, with its r2 and root mean squared error on the fitted rows."""

    target: str
    features: tuple[str, ...]
    intercept: float
    coefficients: np.ndarray
    r2: float | None
    rmse: float

    def predict(self, df: DataFrame) -> Column:
        """The prediction as an expression over ``df``; NULL where a feature is missing."""
        out = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coefficients):
            out = out + number_of(df, c) * F.lit(float(b))
        return out


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Moments of the rows where no column is missing (NULL, NaN or malformed text), in one aggregate of stable updates."""
    columns = list(dict.fromkeys(columns))
    x = df.select(*[number_of(df, c).alias(f"x{i}") for i, c in enumerate(columns)]).dropna()
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)],
                *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((k, k))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    return Moments(tuple(columns), row["n"], np.array([row[f"m{i}"] if row["n"] else np.nan for i in range(k)]), cov)


def fit_linear(m: Moments, target: str, features: Sequence[str] | None = None) -> LinearFit:
    """Least squares from moments. Features are scaled before solving; of features that say the same the
    solution of least size is taken, and one that does not vary gets 0. No rows raise."""
    if not m.n:
        raise ValueError("no complete rows to fit")
    features = [c for c in m.names if c != target] if features is None else list(features)
    at, y = [m.names.index(c) for c in features], m.names.index(target)
    cov, to = m.covariances[np.ix_(at, at)], m.covariances[at, y]
    size = np.sqrt(np.diag(cov))
    varies = size > 0
    scale = np.where(varies, size, 1.0)
    b = np.linalg.lstsq(cov / np.outer(scale, scale), to / scale, rcond=1e-12)[0] / scale if len(at) else np.zeros(0)
    b = np.where(varies, b, 0.0)
    total = float(m.covariances[y, y])
    left = max(total - float(2 * b @ to - b @ cov @ b), 0.0)
    return LinearFit(target, tuple(features), float(m.means[y] - b @ m.means[at]), b, 1 - left / total if total else None, left ** 0.5)
