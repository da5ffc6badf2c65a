"""Elastic-net fits of all folds and penalties from one pass over the rows.

For a handful of scalar features everything a fit needs is in the means and the
centred cross products of features and label. One aggregation gives them for
each fold; the rows are not shuffled and not read again. The moments of all
other folds are those of all rows less those of the fold left out, and each
penalty is a coordinate descent on a small matrix on the driver.

The objective is that of Spark's regression: features and label standardised,
squared error / 2 + penalty / sd(label) * (mixing * |b| + (1 - mixing) / 2 * b^2).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.training import MIXING, PENALTIES
from shelfmark.schema import LABEL

SWEEPS, TOLERANCE = 10_000, 1e-13


@dataclass(frozen=True)
class Moments:
    """Number of rows, means, and centred sums of products; the label comes last."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def none(cls, columns: int) -> Moments:
        return cls(0.0, np.zeros(columns), np.zeros((columns, columns)))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products)

    def __sub__(self, part: Moments) -> Moments:
        """The moments of the rows that are not in `part`."""
        n = self.n - part.n
        if n <= 0:
            return Moments.none(len(self.mean))
        mean = (self.mean * self.n - part.mean * part.n) / n
        apart = part.mean - mean
        return Moments(n, mean, self.products - part.products - np.outer(apart, apart) * (n * part.n / self.n))


@dataclass(frozen=True)
class Line:
    """A fitted plane over named features."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        """The prediction as an expression over the feature columns."""
        total = F.lit(float(self.intercept))
        for name, weight in zip(self.features, self.coefficients):
            total = total + F.col(name) * F.lit(float(weight))
        return total


def fold_moments(rows: DataFrame, features: Sequence[str], label: str = LABEL, fold: str = "fold") -> dict[int, Moments]:
    """The moments of each fold, from one partial aggregation; a row with a gap in any of the columns is left out."""
    columns = [*features, label]
    whole = rows.dropna(subset=[*columns, fold])
    values = [F.col(c).cast("double") for c in columns]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    found = whole.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(v) for v in values]).alias("mean"),
        F.array(*[F.covar_pop(values[i], values[j]) for i, j in pairs]).alias("covariance"),
    )
    out = {}
    for row in found.collect():  # a row per fold
        products = np.zeros((len(columns), len(columns)))
        for (i, j), value in zip(pairs, row["covariance"]):
            products[i, j] = products[j, i] = value * row["n"]
        out[row[fold]] = Moments(float(row["n"]), np.array(row["mean"]), products)
    return out


def fit(moments: Moments, features: Sequence[str], penalty: float, mixing: float = MIXING) -> Line:
    """Coefficients by coordinate descent; a feature that does not vary gets 0, and so do all if the label does not."""
    p = len(moments.mean) - 1
    deviation = np.sqrt(np.diag(moments.products) / max(moments.n, 1))
    weights = np.zeros(p)
    active = np.flatnonzero(deviation[:p] > 0)
    if len(active) and deviation[p] > 0:
        scale = np.outer(deviation, deviation)[np.ix_([*active, p], [*active, p])] * moments.n
        related = moments.products[np.ix_([*active, p], [*active, p])] / scale
        matrix, target = related[:-1, :-1], related[:-1, -1]
        hard, soft = penalty / deviation[p] * mixing, penalty / deviation[p] * (1 - mixing)
        if penalty == 0:
            found = np.linalg.lstsq(matrix, target, rcond=None)[0]
        else:
            found = np.zeros(len(active))
            for _ in range(SWEEPS):
                before = found.copy()
                for j in range(len(active)):
                    pull = target[j] - matrix[j] @ found + matrix[j, j] * found[j]
                    found[j] = np.sign(pull) * max(abs(pull) - hard, 0.0) / (matrix[j, j] + soft)
                if np.abs(found - before).max() <= TOLERANCE:
                    break
        weights[active] = found * deviation[p] / deviation[active]
    return Line(tuple(features), weights, float(moments.mean[p] - weights @ moments.mean[:p]))


def rmse(moments: Moments, line: Line) -> float:
    """Root mean squared error of a plane on the rows that the moments are of."""
    weights = np.append(-line.coefficients, 1.0)
    off = weights @ moments.mean - line.intercept
    return float(np.sqrt(max(weights @ moments.products @ weights / moments.n + off * off, 0.0)))


@dataclass(frozen=True)
class ScalarTuned:
    """The plane of the best penalty on all rows, and the error of every (penalty, fold)."""

    line: Line
    penalty: float
    errors: dict[float, dict[int, float]]

    @property
    def averages(self) -> dict[float, float]:
        return {penalty: sum(by.values()) / len(by) for penalty, by in self.errors.items()}


def tune(rows: DataFrame, features: Sequence[str], penalties: Sequence[float] = PENALTIES, label: str = LABEL,
         fold: str = "fold", mixing: float = MIXING) -> ScalarTuned:
    """Fit every penalty without each fold in turn and the best one on all rows, all from one aggregation."""
    by_fold = fold_moments(rows, features, label, fold)
    if not by_fold:
        raise ValueError("no rows to learn from")
    whole = sum(by_fold.values(), Moments.none(len(features) + 1))
    errors = {
        penalty: {k: rmse(held, fit(whole - held, features, penalty, mixing)) for k, held in sorted(by_fold.items())}
        for penalty in penalties
    }
    best = min(penalties, key=lambda penalty: sum(errors[penalty].values()))
    return ScalarTuned(fit(whole, features, best, mixing), best, errors)
