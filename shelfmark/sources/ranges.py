"""Cuts of a table into parts of equal weight by ranges of a key.

Equal ranges of a key give unequal parts when keys are unevenly spread. Here the
cuts are quantiles of the keys, from Spark's mergeable quantile sketch, so they
hold about the same number of rows each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The sketch puts a cut within rows / ACCURACY rows of its place.
ACCURACY = 100_000


def cuts(keys: DataFrame, column: str, parts: int, accuracy: int = ACCURACY) -> list[int]:
    """At most `parts` - 1 ascending keys at which the parts begin; fewer if few keys hold most rows."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, shares, accuracy)).first()[0] or []
    least = keys.agg(F.min(column)).first()[0]
    # a cut is the first key of its part; one at the least key would leave an empty part before it
    return [c for c in sorted(set(found)) if c != least]


def predicates(keys: DataFrame, column: str, parts: int, accuracy: int = ACCURACY) -> list[str]:
    """Conditions of which every row meets exactly one; rows without a key have one of their own.

    A part holds at most rows / parts, plus the rows of its last key, plus
    2 * rows / `accuracy`: a key's rows cannot be parted by ranges.
    """
    at = cuts(keys, column, parts, accuracy)
    missing = f"{column} IS NULL"
    if not at:
        return [f"{column} IS NOT NULL", missing]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])]
    return [f"{column} < {at[0]}", *inner, f"{column} >= {at[-1]}", missing]


def jdbc_scan_by(spark: SparkSession, url: str, table: str, conditions: list[str],
                 properties: Mapping[str, str] | None = None) -> DataFrame:
    """A relational table read by one connection per condition."""
    return spark.read.jdbc(url, table, predicates=conditions, properties=dict(properties or {}))


def part_sizes(rows: DataFrame, conditions: list[str]) -> DataFrame:
    """(part, n, largest key's n, meets): rows by the condition that they meet, and how many conditions a row meets."""
    met = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)]))
    return rows.select(F.get(met, F.lit(0)).alias("part"), F.size(met).alias("meets")).groupBy("part", "meets").agg(
        F.count(F.lit(1)).alias("n")
    )
