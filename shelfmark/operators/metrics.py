"""Regression errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame,
    label: str = "eclassnumber",
    prediction: str = "prediction",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """mae, mse, rmse and r2 from one aggregation, optionally per group.

    `n_used` rows have both a label and a prediction; the other `n_left_out`
    take no part in the errors. r2 is NULL where the label does not vary.
    """
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    actual = F.when(both, F.col(label).cast("double"))
    error = actual - F.col(prediction).cast("double")
    spread = F.var_pop(actual) * F.count(actual)
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
        F.count(error).alias("n_used"),
        (F.count(F.lit(1)) - F.count(error)).alias("n_left_out"),
    )
