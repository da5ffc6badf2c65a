"""Actual-versus-predicted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.schema import LABEL

TOP = 100


def result_table(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, prediction) with the prediction cut toward zero; NULL when it fits no int."""
    return predictions.select(label, F.col("prediction").try_cast("int").alias("prediction"))


def sorted_by_actual(result: DataFrame, label: str = LABEL) -> DataFrame:
    """Global order by label, then prediction.

    The row number as last key changes nothing a reader can see, but lets range
    partitioning cut a run of equal rows that would otherwise be one task's.
    """
    tied = result.withColumn("_row", F.monotonically_increasing_id())
    return tied.orderBy(label, "prediction", "_row").drop("_row")


def top_rows(result: DataFrame, n: int = TOP, label: str = LABEL) -> DataFrame:
    """The first `n` rows in label order: per-partition tops, then one merge of those."""
    return result.orderBy(label, "prediction").limit(n)


def chart_series(result: DataFrame, label: str = LABEL) -> DataFrame:
    """(actual, series, value): the predictions and the identity line they are held against."""
    points = F.array(
        F.struct(F.lit("prediction").alias("series"), F.col("prediction").alias("value")),
        F.struct(F.lit("identity").alias("series"), F.col(label).alias("value")),
    )
    return result.select(F.col(label).alias("actual"), F.inline(points))


def _bin(column: Column, width: int) -> Column:
    return (F.floor(column / width) * width).cast("bigint")


def chart_bins(result: DataFrame, width: int, label: str = LABEL) -> DataFrame:
    """(actual_bin, prediction_bin, n): the scatter as counts, its size set by `width`."""
    return result.groupBy(
        _bin(F.col(label), width).alias("actual_bin"),
        _bin(F.col("prediction"), width).alias("prediction_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))
