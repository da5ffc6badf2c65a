"""Elastic-net regression and its cross-validation over penalties."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.split import FOLDS
from shelfmark.plans import lockstep
from shelfmark.schema import LABEL

# The penalties tried and the settings of every fit.
PENALTIES = (0.0, 0.1, 0.01)
MIXING = 0.5
ITERATIONS = 20

# Slots up to which the library solves a fit from one table of products; wider ones take a pass a step.
NARROW = 4096


def regression(penalty: float = 0.0, mixing: float = MIXING, label: str = LABEL) -> LinearRegression:
    return LinearRegression(
        labelCol=label, regParam=penalty, elasticNetParam=mixing, maxIter=ITERATIONS
    )


@dataclass(frozen=True)
class Tuned:
    """The refitted best model, and the RMSE of every (penalty, fold)."""

    model: LinearRegressionModel
    penalty: float
    errors: dict[float, list[float]]

    @property
    def averages(self) -> dict[float, float]:
        return {penalty: sum(found) / len(found) for penalty, found in self.errors.items()}


def _fold_errors(
    validation: DataFrame, models: Sequence[LinearRegressionModel], label: str
) -> list[float]:
    """RMSE of several models from one pass over a fold."""
    scored = validation
    for i, model in enumerate(models):
        scored = model.copy({model.predictionCol: f"p{i}"}).transform(scored)
    squares = [F.pow(F.col(label) - F.col(f"p{i}"), 2) for i in range(len(models))]
    return list(scored.agg(*[F.sqrt(F.avg(square)) for square in squares]).first())


def tune(
    train: DataFrame,
    penalties: Sequence[float] = PENALTIES,
    folds: int = FOLDS,
    fold: str = "fold",
    label: str = LABEL,
    parallelism: int = 1,
) -> Tuned:
    """Fit every penalty without each fold in turn, then the best one on all rows.

    `train` carries its fold numbers, so results do not vary between runs. Give
    a table partitioned by `fold`: then each fit scans only the folds it uses.
    `parallelism` fits are in flight at once; each holds its own copy of the
    rows in memory or on executor disks, so raise it only for a small table.
    Vectors of more than `NARROW` slots are fitted in step: they are packed
    once, and one pass over them serves all fits.
    """
    jobs = [(held, penalty) for held in range(folds) for penalty in penalties]

    def fit(job: tuple[int, float]) -> LinearRegressionModel:
        held, penalty = job
        return regression(penalty, label=label).fit(train.where(F.col(fold) != held))

    def score(held: int) -> list[float]:
        models = fitted[held * len(penalties) : (held + 1) * len(penalties)]
        return _fold_errors(train.where(F.col(fold) == held), models, label)

    def line(penalty: float) -> LinearRegression:
        return regression(penalty, label=label)

    one = train.select("features").first()
    width = one["features"].size if one and one["features"] is not None else 0
    with ThreadPool(parallelism) as pool:
        if width > NARROW:
            rows = lockstep.packed_rows(train, fold, label)
            moments = lockstep.fold_moments(rows, width)
            fitted = lockstep.fit_all(rows, width, moments, jobs, line)
        else:
            fitted = pool.map(fit, jobs, chunksize=1)
        by_fold = pool.map(score, range(folds), chunksize=1)
    errors = {penalty: [found[k] for found in by_fold] for k, penalty in enumerate(penalties)}
    best = min(penalties, key=lambda penalty: sum(errors[penalty]))
    if width > NARROW:
        return Tuned(lockstep.fit_all(rows, width, moments, [(None, best)], line)[0], best, errors)
    return Tuned(line(best).fit(train), best, errors)
