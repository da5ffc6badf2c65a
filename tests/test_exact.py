"""Exact splits, exact top terms, balanced parts, data-driven bins, and fits from moments."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from shelfmark.operators import density, exact, terms, topk
from shelfmark.plans import moments
from shelfmark.sources import ranges


@pytest.mark.parametrize("rows", [0, 1, 2, 9, 10, 11, 1000])
@pytest.mark.parametrize("tenths", [0, 3, 7, 10])
def test_exactly_the_wanted_number_of_keys_falls_on_one_side(spark, rows, tenths):
    df = spark.range(rows).union(spark.range(rows // 2)).union(spark.createDataFrame([(None,)], "id long")).repartition(3)
    found = exact.exact_split(df, tenths=tenths).collect()
    sides = {side: {r["id"] for r in found if r["split"] == side} for side in ("train", "test", "rejected")}
    assert len(sides["train"]) == rows * tenths // 10 and not sides["train"] & sides["test"]
    assert sides["rejected"] == {None} and len(found) == rows + rows // 2 + 1


def test_thresholds_at_every_number(spark):
    rng = random.Random(1)
    for digits in ("0123456789abcdef", "0", "0f"):
        digests = sorted({"".join(rng.choices(digits, k=3)) + "".join(rng.choices("0123456789abcdef", k=29)) for _ in range(40)})
        keys = spark.createDataFrame([(d,) for d in digests], "digest string")
        for wanted in (0, 1, 2, 17, len(digests) - 1, len(digests)):
            end = exact.threshold(keys, wanted)
            assert sum(d[: len(end)] <= end for d in digests) == wanted


@pytest.mark.parametrize("bits", [64, 62, 3])
@pytest.mark.parametrize("size", [1, 5, 30, 1000])
def test_top_terms_are_exact_even_if_names_collide(spark, monkeypatch, bits, size):
    rng = random.Random(size)
    rows = [[f"t{min(rng.randrange(40), rng.randrange(60))}" for _ in range(rng.randrange(12))] for _ in range(60)] + [None, []]
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "id int, terms array<string>").repartition(4)
    wanted = {r["term"]: (r["cf"], r["df"], r["rank"]) for r in terms.vocabulary(terms.term_stats(df, "terms"), size).collect()}
    whole = topk.name_of
    # keeps the order of the digest: only its first bits tell names apart
    monkeypatch.setattr(topk, "name_of", lambda term: F.shiftleft(F.shiftright(whole(term), 64 - bits), 64 - bits) if bits < 64 else whole(term))
    found = {r["term"]: (r["cf"], r["df"], r["rank"]) for r in topk.top_terms(df, "terms", size).collect()}
    assert found == wanted
    assert topk.top_terms(df.where(F.lit(False)), "terms", size).count() == 0


def parts_of(rows, parts, key="k"):
    conditions = ranges.predicates(rows, key, parts)
    return conditions, rows.select(F.array(*[F.expr(c) for c in conditions]).alias("met"), key).collect()


@pytest.mark.parametrize("parts", [1, 2, 7, 16])
def test_every_row_meets_one_condition_and_parts_are_balanced(spark, parts):
    rng = random.Random(parts)
    keys = [int(rng.lognormvariate(8, 3)) - 5 for _ in range(3000)] + [7] * 400 + [None] * 50
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    conditions, met = parts_of(rows, parts)
    assert all(sum(bool(x) for x in r["met"]) == 1 for r in met) and all(r["met"][-1] == (r["k"] is None) for r in met)
    sizes = Counter(r["met"].index(True) for r in met if r["k"] is not None)
    assert max(sizes.values()) <= 3400 / parts + max(Counter(keys).values()) and len(sizes) == len(conditions) - 1


def test_odd_keys_have_conditions_too(spark):
    for keys in ([], [None], [3], [3, 3, None], [3, 4], [-(2**62), 0, 2**62]):
        _, met = parts_of(spark.createDataFrame([(k,) for k in keys], "k long"), 4)
        assert [sum(bool(x) for x in r["met"]) for r in met] == [1] * len(keys)


def test_cells_follow_the_data(spark):
    rng = np.random.default_rng(0)
    actual = np.concatenate([rng.lognormal(0, 3, 4000), np.full(500, 2.0)])
    rows = [(float(a), float(a + e)) for a, e in zip(actual, rng.normal(0, 1, len(actual)))] + [(None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "eclassnumber double, prediction double")
    cells = density.quantile_bins(df, 6, 5).collect()
    assert sum(c["n"] for c in cells) == 4500 and {c["strip"] for c in cells} == set(range(6))
    strips = {k: sum(c["n"] for c in cells if c["strip"] == k) for k in range(6)}
    assert max(strips.values()) <= 4500 / 6 + 501
    assert all(c["n"] <= strips[c["strip"]] / 5 + 1 for c in cells)
    for a, b in itertools.combinations(cells, 2):
        apart = a["strip"] != b["strip"] and (a["actual_max"] < b["actual_min"] or b["actual_max"] < a["actual_min"])
        assert apart or a["strip"] == b["strip"] and (a["prediction_max"] < b["prediction_min"] or b["prediction_max"] < a["prediction_min"])
    assert density.quantile_bins(df.where(F.lit(False)), 3, 3).count() == 0
    assert [c["n"] for c in density.quantile_bins(df.select(F.lit(1).alias("eclassnumber"), F.lit(2).alias("prediction")), 4, 4).collect()] == [4502]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4)) * [1, 20, 0.1, 1] + [5, -3, 0, 1000]
    x[:, 3] = 7.0  # does not vary
    y = 3 * x[:, 0] - 0.4 * x[:, 1] + 10 * x[:, 2] + rng.normal(size=600) * 2 + 50
    rows = [(*map(float, row), float(label), i % 5) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, fold int")


def test_moments_add_and_subtract(noisy):
    by = moments.fold_moments(noisy, ["a", "b"], "y")
    whole = sum(by.values(), moments.Moments.none(3))
    data = np.array([[r["a"], r["b"], r["y"]] for r in noisy.collect()])
    fold = np.array([r["fold"] for r in noisy.collect()])
    for some, rows in ((whole, data), (whole - by[2], data[fold != 2]), (by[2], data[fold == 2])):
        assert some.n == len(rows)
        np.testing.assert_allclose(some.mean, rows.mean(axis=0), rtol=1e-12)
        np.testing.assert_allclose(some.products, np.cov(rows.T, bias=True) * len(rows), rtol=1e-9, atol=1e-9)
    assert (by[2] - by[2]).n == 0


def test_tuning_equals_cross_validator(noisy):
    names, penalties = ["a", "b", "c", "d"], [0.0, 0.5, 3.0]
    tuned = moments.tune(noisy, names, penalties, "y")
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(noisy)
    line = LinearRegression(labelCol="y", elasticNetParam=moments.MIXING, maxIter=500, tol=1e-12)
    grid = ParamGridBuilder().addGrid(line.regParam, penalties).build()
    evaluator = RegressionEvaluator(labelCol="y")
    fitted = CrossValidator(estimator=line, estimatorParamMaps=grid, evaluator=evaluator, foldCol="fold", numFolds=5).fit(vectors)
    np.testing.assert_allclose([tuned.averages[p] for p in penalties], fitted.avgMetrics, rtol=1e-6)
    assert tuned.penalty == penalties[int(np.argmin(fitted.avgMetrics))]
    best = fitted.bestModel
    np.testing.assert_allclose(tuned.line.coefficients, best.coefficients.toArray(), rtol=1e-5, atol=1e-7)
    scored = noisy.withColumn("prediction", tuned.line.prediction())
    wanted = best.transform(vectors).agg(F.sum("prediction")).first()[0]
    assert scored.agg(F.sum("prediction")).first()[0] == pytest.approx(wanted, rel=1e-7)


def test_gaps_constant_labels_and_no_rows(spark, noisy):
    gapped = noisy.withColumn("a", F.when(F.col("fold") != 3, F.col("a")))
    assert set(moments.fold_moments(gapped, ["a", "b"], "y")) == {0, 1, 2, 4}
    flat = moments.tune(noisy.withColumn("y", F.lit(4.0)), ["a", "d"], [0.0, 1.0], "y")
    assert not flat.line.coefficients.any() and flat.line.intercept == 4.0 and max(flat.averages.values()) < 1e-9
    with pytest.raises(ValueError):
        moments.tune(noisy.where("a IS NULL"), ["a"], [0.0], "y")
