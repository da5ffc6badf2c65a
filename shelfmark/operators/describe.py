"""Typed summary statistics in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _statistics(column: str) -> list[Column]:
    return [
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ]


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample standard deviation, min and max."""
    return df.agg(*_statistics(column))


def describe_by(df: DataFrame, column: str, group: str, total: str = "all") -> DataFrame:
    """The same for every value of `group` and for the whole table, from one scan."""
    return (
        df.rollup(group)
        .agg(F.grouping(group).alias("is_total"), *_statistics(column))
        .withColumn(group, F.when(F.col("is_total") == 1, F.lit(total)).otherwise(F.col(group)))
        .drop("is_total")
    )
