"""The whole job: catalogue table to tuned model, scored test rows and error metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.metrics import regression_metrics
from shelfmark.operators.report import result_table, sorted_by_actual
from shelfmark.operators.split import in_train, with_split
from shelfmark.plans.features import feature_vectors, fit_features
from shelfmark.plans.training import Tuned, tune
from shelfmark.session import materialize

# Stored vectors in a partition of the training data; in memory they take about three times as much.
PART_BYTES = 64 << 20


@dataclass(frozen=True)
class Outcome:
    features: PipelineModel
    tuned: Tuned
    predictions: DataFrame
    rejected: DataFrame

    @property
    def metrics(self) -> DataFrame:
        return regression_metrics(self.predictions)

    @property
    def result(self) -> DataFrame:
        return sorted_by_actual(result_table(self.predictions))


def feature_table(
    catalogue: DataFrame,
    model: PipelineModel,
) -> DataFrame:
    """Feature vectors with split and fold, written once and pruned by both."""
    split = with_split(feature_vectors(catalogue, model))
    return in_large_parts(materialize(split, "features", ("split", "fold")))


def in_large_parts(table: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """A table of files in partitions of about `part_bytes`, one per core at least.

    Every iteration of a fit shuffles a gradient as wide as the vectors for each
    partition, so what it costs is given by their number: the many files of a
    partitioned table would make hundreds of small ones.
    """
    files = table.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size")).first()[0] or 0
    return table.coalesce(max(table.sparkSession.sparkContext.defaultParallelism, -(-size // part_bytes)))


def run(
    catalogue: DataFrame,
    fit_on: str = "all",
    drop_id: bool = False,
    vocabulary_size: int | None = None,
    parallelism: int = 1,
) -> Outcome:
    """Fit features, split, tune on the train rows and score the test rows.

    `fit_on="train"` learns the vocabularies without the test rows, and
    `drop_id=True` leaves the row number out of the features. Rows without id
    or label can be neither split nor learned from; they come back as `rejected`.
    `parallelism` fits run at once, each with its own copy of the train rows.
    Every term counts, by bucket; a `vocabulary_size` keeps the top terms instead.
    """
    whole = F.col("id").isNotNull() & F.col("eclassnumber").isNotNull()
    rejected, catalogue = catalogue.where(~whole), catalogue.where(whole)
    known = catalogue if fit_on == "all" else catalogue.where(in_train(F.col("id")))
    model = fit_features(known, vocabulary_size, drop_id)
    table = feature_table(catalogue, model)
    tuned = tune(table.where("split = 'train'"), parallelism=parallelism)
    scored = tuned.model.transform(table.where("split = 'test'"))
    predictions = materialize(scored.select("id", "eclassnumber", "prediction"), "predictions")
    return Outcome(model, tuned, predictions, rejected)
