"""Relational table scan, cut into ranges of a numeric column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


def range_options(
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int,
    column: str = "id",
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for `partitions` concurrent range scans of `table`."""
    return {
        "fetchsize": str(FETCH_ROWS),
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str = "eclasses",
    column: str = "id",
    partitions: int | None = None,
    bounds: tuple[int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """The whole table, read by several connections at once.

    Without `bounds` the database is asked for the least and greatest `column`.
    Bounds only place the cuts: rows outside them, and rows with a NULL key, are
    still read. The connections do not share a transaction, so read a table that
    is at rest or a database-side snapshot of it.
    """
    extra = dict(properties or {})
    if bounds is None:
        extremes = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) extremes"
        lo, hi = spark.read.format("jdbc").options(url=url, dbtable=extremes, **extra).load().first()
        bounds = (0, 1) if lo is None else (int(lo), int(hi) + 1)
    wanted = partitions or spark.sparkContext.defaultParallelism
    options = range_options(url, table, *bounds, wanted, column, extra)
    return spark.read.format("jdbc").options(**options).load()
