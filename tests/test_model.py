import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from checks.tables import catalogue
from shelfmark.functions import text
from shelfmark.operators import describe, metrics, report, split, terms
from shelfmark.plans import features, flow, training
from shelfmark.schema import CATALOGUE


@pytest.fixture(scope="module")
def whole(spark, sf_dir):
    return catalogue(spark, sf_dir)


@pytest.fixture(scope="module")
def model(whole):
    return features.fit_features(whole, terms.VOCABULARY_SIZE)


def named(spark, df, model):
    slots = features.vector_slots(features.feature_vectors(df, model))
    rows = slots.join(features.slot_names(spark, model), "slot").collect()
    return {(r["id"], r["part"], r["term"]): r["value"] for r in rows}


def test_stock_stages_give_the_same_weights(spark, whole, model):
    """Count vectors and IDF as Spark fits them, term by term."""
    for feature in (features.DESCRIPTION, features.CATEGORY):
        stock = Pipeline(
            stages=[
                *features.term_stages(feature),
                CountVectorizer(inputCol=feature.terms, outputCol="c"),
                IDF(inputCol="c", outputCol="w"),
            ]
        ).fit(whole)
        vocabulary = stock.stages[-2].vocabulary
        plain = F.unwrap_udt("w")
        pairs = F.arrays_zip(plain.getField("indices").alias("i"), plain.getField("values").alias("v"))
        rows = stock.transform(whole).select("id", F.inline(pairs)).collect()
        wanted = {(r[0], feature.column, vocabulary[r[1]]): r[2] for r in rows if r[2]}
        found = {k: v for k, v in named(spark, whole, model).items() if k[1] == feature.column and k[2] is not None}
        assert found.keys() == wanted.keys()
        assert all(found[k] == pytest.approx(wanted[k], abs=1e-9) for k in wanted)


def test_buckets_leave_no_term_out(spark, whole):
    """The counts of all buckets add up to all terms, and every term is in the table of its bucket."""
    model = features.fit_features(whole, buckets={"description": 64})
    rows = PipelineModel(model.stages).transform(features.with_description_length(features.without_gaps(whole)))
    counts = F.unwrap_udt("count_vec").getField("values")
    total = rows.select(F.aggregate(counts, F.lit(0.0), lambda a, v: a + v).alias("n"), F.size("ngram").alias("m"))
    assert total.where("n != m").count() == 0
    listed = features.bucket_terms(whole, features.DESCRIPTION, 64)
    assert listed.agg(F.max("bucket")).first()[0] < 64
    assert listed.count() == listed.select("term").distinct().count()


def odd_rows(spark):
    """Copies, gaps, short and long texts, blanks and words of other scripts."""
    texts = [None, "", " ", "a b c d e", "A  b\tc d e f", "the " * 9, "é Ü ß İ x y z é Ü ß", "x y z " * 700, "x y z " * 700]
    rows = [(i % 7, t, c, *[None if i % 3 else True] * 10, None if i % 5 == 0 else i)
            for i, (t, c) in enumerate((t, c) for t in texts for c in (None, "", "de the src", "B b"))]
    return spark.createDataFrame(rows, CATALOGUE).repartition(3)


def test_rows_are_counted_once_and_as_the_stages_count_them(spark):
    df = odd_rows(spark)
    model = features.fit_features(df, buckets={"description": 300, "category": 7})
    kept, again = (features.feature_vectors(df, m) for m in (model, PipelineModel(model.stages)))
    assert sorted(kept.collect(), key=repr) == sorted(again.collect(), key=repr) and kept.count() == df.count()
    assert kept.inputFiles() and all("/counted-" in path for path in kept.inputFiles())
    for feature in (features.DESCRIPTION, features.CATEGORY):
        rows = PipelineModel(model.stages).transform(features.with_description_length(features.without_gaps(df)))
        stock = IDF(inputCol=feature.counts, outputCol="w").fit(rows)
        scaler = next(s for s in model.stages if s.hasParam("scalingVec") and s.getOutputCol() == feature.weights)
        assert scaler.getScalingVec().toArray() == pytest.approx(stock.idf.toArray(), abs=1e-12)


def test_other_rows_are_counted_by_the_stages(spark):
    df = odd_rows(spark)
    model = features.fit_features(df, buckets={"description": 300, "category": 7})
    swapped = df.select("id", F.col("category").alias("description"), F.col("description").alias("category"), *df.columns[3:])
    for other in (df.where("id > 3"), swapped, df.withColumn("description", F.upper("description"))):
        found, wanted = (features.feature_vectors(other, m) for m in (model, PipelineModel(model.stages)))
        assert sorted(found.collect(), key=repr) == sorted(wanted.collect(), key=repr)


@pytest.mark.parametrize("drop_id", [False, True])
def test_the_table_of_the_fits_is_made_from_the_counts(spark, monkeypatch, drop_id):
    """What `linreg_fit`, `cv_metrics` and the whole flow learn from: the texts are not gone through a second time."""
    df = odd_rows(spark)
    model = features.fit_features(df, drop_id=drop_id, buckets={"description": 300, "category": 7})
    wanted = split.with_split(features.feature_vectors(df, PipelineModel(model.stages)))

    def counting(*_):
        raise AssertionError("counted again")

    monkeypatch.setattr(CountVectorizerModel, "_transform", counting)
    found = flow.feature_table(df, model).select(*wanted.columns)
    assert sorted(found.collect(), key=repr) == sorted(wanted.collect(), key=repr)


def test_the_table_of_the_fits_is_read_in_few_large_parts(spark, capsys):
    """However many files its writers made; splits and folds are still left out at the scan."""
    df = odd_rows(spark).repartition(20)
    model = features.fit_features(df, buckets={"description": 30, "category": 7})
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        table = flow.feature_table(df, model)
        train = table.where("split = 'train' AND fold != 1")
        assert table.rdd.getNumPartitions() == 8 and 1 <= train.rdd.getNumPartitions() <= 8
        assert flow.in_large_parts(table, 1000).rdd.getNumPartitions() <= len(table.inputFiles())
        train.explain()
        scan = next(line for line in capsys.readouterr().out.splitlines() if "FileScan" in line)
        assert "fold" in scan.split("PartitionFilters:")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert table.count() == df.count()
    assert flow.in_large_parts(table.where("false")).count() == 0


def test_rows_without_id_or_label_come_back(spark, whole):
    odd = whole.limit(2).withColumn("id", F.lit(None).cast("int")).unionAll(
        whole.limit(1).withColumn("eclassnumber", F.lit(None).cast("int"))
    )
    outcome = flow.run(whole.unionAll(odd), vocabulary_size=40)
    assert outcome.rejected.count() == 3
    assert outcome.predictions.count() == whole.where(~split.in_train(F.col("id"))).count()


def test_missing_values_are_filled_before_the_stages(spark, model):
    gap = spark.createDataFrame([(1, None, None, *[None] * 10, 5)], CATALOGUE)
    vector = features.feature_vectors(gap, model).first()["features"]
    assert vector.numNonzeros() == 1


def test_vectors_carry_no_slot_metadata(whole, model):
    assert features.feature_vectors(whole, model).schema["features"].metadata == {}


def test_slots_are_the_same_in_every_run(spark, whole, model):
    again = features.fit_features(whole.repartition(5), terms.VOCABULARY_SIZE)
    first, second = (sorted(map(tuple, features.slot_names(spark, m).collect()), key=repr) for m in (model, again))
    assert first == second


def test_no_terms_is_an_error(spark):
    df = spark.createDataFrame([(1, "short", "c", *[True] * 10, 5)], CATALOGUE)
    with pytest.raises(ValueError, match="description"):
        features.fit_features(df, vocabulary_size=10)


def test_tuning_agrees_with_cross_validator(whole):
    small = features.fit_features(whole, vocabulary_size=40)
    train = flow.feature_table(whole, small).where("split = 'train'").drop("split", "id")
    tuned = training.tune(train)
    line = training.regression()
    grid = ParamGridBuilder().addGrid(line.regParam, list(training.PENALTIES)).build()
    stock = CrossValidator(
        estimator=line,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol="eclassnumber"),
        numFolds=split.FOLDS,
        foldCol="fold",
    ).fit(train)
    assert [tuned.averages[p] for p in training.PENALTIES] == pytest.approx(stock.avgMetrics, rel=1e-6)
    assert tuned.penalty == stock.bestModel.getRegParam()


def test_whole_flow(whole):
    outcome = flow.run(whole, fit_on="train", drop_id=True, vocabulary_size=500)
    tests = whole.where(~split.in_train(F.col("id"))).count()
    assert outcome.predictions.count() == tests == outcome.result.count()
    found = outcome.metrics.first()
    assert found["rmse"] ** 2 == pytest.approx(found["mse"])
    for name in ("mae", "mse", "rmse", "r2"):
        stock = RegressionEvaluator(labelCol="eclassnumber", metricName=name)
        assert found[name] == pytest.approx(stock.evaluate(outcome.predictions))
    labels = [r["eclassnumber"] for r in outcome.result.collect()]
    assert labels == sorted(labels)


def test_long_form_agrees_with_vectors(spark, whole, model):
    long = whole.select("id", text.catalogue_terms(F.col("description"), 5).alias("terms"))
    wanted = {
        (r["id"], r["term"]): r["tfidf"]
        for r in terms.tfidf(long, "id", "terms", terms.VOCABULARY_SIZE).collect()
        if r["tfidf"]
    }
    found = {(k[0], k[2]): v for k, v in named(spark, whole, model).items() if k[1] == "description" and k[2] is not None}
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(wanted[k], abs=1e-9) for k in wanted)


def test_split_does_not_depend_on_partitioning(whole):
    def parts(df):
        return sorted((r["id"], r["split"], r["fold"]) for r in split.with_split(df.select("id")).collect())

    assert parts(whole) == parts(whole.repartition(13))
    assert {r[2] for r in parts(whole)} == set(range(split.FOLDS))


def test_random_split_covers_every_row_once(whole):
    train, test = split.random_split(whole.select("id"))
    assert train.count() + test.count() == whole.count()
    assert train.join(test, "id").count() == 0


def test_prediction_cast(spark):
    df = spark.createDataFrame([(1, 2.9), (1, -2.9), (1, 1e12), (1, None)], "eclassnumber int, prediction double")
    assert [r["prediction"] for r in report.result_table(df).collect()] == [2, -2, None, None]


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(5, 4.0), (5, 6.0), (None, 1.0), (7, None)], "eclassnumber int, prediction double")
    found = metrics.regression_metrics(df).first()
    assert (found["mae"], found["mse"], found["rmse"], found["r2"]) == (1.0, 1.0, 1.0, None)


def test_describe_agrees_with_spark(whole):
    stock = {r["summary"]: r["eclassnumber"] for r in whole.select("eclassnumber").describe().collect()}
    found = describe.describe(whole, "eclassnumber").first()
    assert float(stock["mean"]) == pytest.approx(found["mean"]) and int(stock["max"]) == found["max"]
    assert float(stock["stddev"]) == pytest.approx(found["stddev"]) and int(stock["count"]) == found["count"]
