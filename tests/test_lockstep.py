"""Fits in step against the library's own, step by step: the same coefficients after any number of them."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression

from shelfmark.plans import lockstep, training


def line(penalty, iterations=20):
    return LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=0.5, maxIter=iterations, solver="l-bfgs")


@pytest.fixture(scope="module")
def rows(spark):
    """Sparse and whole vectors, slots of very different size, one that is always the same and one never used."""
    rng, width, out = np.random.default_rng(5), 60, []
    truth = rng.normal(size=width) * (rng.random(width) < 0.4)
    for i in range(900):
        x = rng.poisson(0.4, width) * rng.gamma(2, 1, width).round(1)
        x[0], x[1], x[2], x[3] = 1e4 + i, 7.3, 0, rng.integers(0, 2)
        y = int(2e6 + 3e5 * (truth @ x) / 5 + 1e5 * rng.normal())
        vector = Vectors.dense(x) if i % 50 == 0 else Vectors.sparse(width, np.flatnonzero(x).tolist(), x[x != 0].tolist())
        out.append((vector, y, i % 5 if i % 97 else None))
    return spark.createDataFrame(out, ["features", "y", "fold"]).repartition(5)


@pytest.fixture(scope="module")
def packed(rows):
    made = lockstep.packed_rows(rows, "fold", "y")
    return made, lockstep.fold_moments(made, 60)


@pytest.mark.parametrize("iterations", [1, 2, 3, 7, 20])
def test_coefficients_after_some_steps(rows, packed, iterations):
    jobs = [(held, penalty) for held in (None, 2) for penalty in (0.0, 0.1, 3e3, 4e4, 1e6)]
    found = lockstep.fit_all(packed[0], 60, packed[1], jobs, lambda p: line(p, iterations))
    for (held, penalty), model in zip(jobs, found):
        stock = line(penalty, iterations).fit(rows if held is None else rows.where(f"fold != {held}"))
        scale = np.abs(stock.coefficients.toArray()).max() + 1e-9
        assert np.abs(model.coefficients.toArray() - stock.coefficients.toArray()).max() < 1e-6 * scale, (held, penalty)
        assert model.intercept == pytest.approx(stock.intercept, rel=1e-6)


def test_wide_tuning_is_that_of_single_fits(rows, monkeypatch):
    wanted = training.tune(rows.where("fold IS NOT NULL"), (0.0, 2e3), label="y")
    monkeypatch.setattr(training, "regression", lambda penalty=0.0, mixing=0.5, label="y": line(penalty))
    single = training.tune(rows.where("fold IS NOT NULL"), (0.0, 2e3), label="y")
    monkeypatch.setattr(training, "NARROW", 10)
    monkeypatch.setattr(lockstep, "FITS", 3)
    monkeypatch.setattr(lockstep, "BLOCK_VALUES", 500)
    found = training.tune(rows.where("fold IS NOT NULL"), (0.0, 2e3), label="y")
    assert found.penalty == single.penalty and found.errors.keys() == wanted.errors.keys()
    for penalty, errors in single.errors.items():
        assert found.errors[penalty] == pytest.approx(errors, rel=1e-7)
    assert found.model.transform(rows).select("prediction").first()[0] == pytest.approx(single.model.transform(rows).select("prediction").first()[0], rel=1e-7)


def test_a_label_that_does_not_vary(spark):
    df = spark.createDataFrame([(Vectors.sparse(3, [0], [float(i)]), 5, i % 2) for i in range(8)], ["features", "y", "fold"])
    made = lockstep.packed_rows(df, "fold", "y")
    model = lockstep.fit_all(made, 3, lockstep.fold_moments(made, 3), [(None, 0.1)], line)[0]
    assert model.intercept == 5.0 and not model.coefficients.toArray().any()


def test_one_pass_serves_all_fits(packed, monkeypatch):
    passes, products = [], lockstep._products
    monkeypatch.setattr(lockstep, "_products", lambda rows, fits, points: passes.append(len(fits)) or products(rows, fits, points))
    lockstep.fit_all(packed[0], 60, packed[1], [(held, 0.0) for held in range(5)], line)
    assert max(passes) == 5 and len(passes) <= 20


def test_a_label_that_is_no_number_is_an_error(spark):
    df = spark.createDataFrame([(Vectors.sparse(3, [0], [1.0]), float("nan"), 0)], ["features", "y", "fold"])
    with pytest.raises(Exception, match="no number"):
        lockstep.packed_rows(df, "fold", "y").count()
