"""The actual-versus-predicted scatter in bins that follow the data.

Bins of one fixed width are empty where there are no rows and overfull where
most are. Here the actual values are cut at their quantiles, and inside each
such strip the predictions at theirs, so every cell holds about the same number
of rows, and the table has at most `strips` times `cells` rows at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.schema import LABEL

STRIPS, CELLS = 16, 16
ACCURACY = 100_000


def _cuts(column: Column, parts: int, accuracy: int) -> Column:
    """Ascending distinct values at which the parts after the first begin."""
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    return F.array_sort(F.array_distinct(F.coalesce(F.percentile_approx(column, shares, accuracy), F.array())))


def _place(value: Column, cuts: Column) -> Column:
    """The number of cuts at or below a value: the part that it lies in."""
    return F.size(F.filter(cuts, lambda c: c <= value))


def quantile_bins(result: DataFrame, strips: int = STRIPS, cells: int = CELLS, label: str = LABEL, accuracy: int = ACCURACY) -> DataFrame:
    """(strip, cell, n, actual_min, actual_max, prediction_min, prediction_max) of every cell that has rows.

    Rows that lack either value are left out. A cell holds at most about
    1 / (strips * cells) of the rows, and the rows that share its last actual
    value or prediction besides: equal values are never parted.
    """
    points = result.select(F.col(label).cast("double").alias("actual"), F.col("prediction").cast("double").alias("predicted")).dropna()
    # one small row of cuts, and one per strip: both bounded by the parameters
    across = F.broadcast(points.agg(_cuts(F.col("actual"), strips, accuracy).alias("cuts")))
    placed = points.join(across).select("actual", "predicted", _place(F.col("actual"), F.col("cuts")).alias("strip"))
    down = F.broadcast(placed.groupBy("strip").agg(_cuts(F.col("predicted"), cells, accuracy).alias("cuts")))
    celled = placed.join(down, "strip").withColumn("cell", _place(F.col("predicted"), F.col("cuts")))
    return celled.groupBy("strip", "cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("actual").alias("actual_min"), F.max("actual").alias("actual_max"),
        F.min("predicted").alias("prediction_min"), F.max("predicted").alias("prediction_max"),
    )
