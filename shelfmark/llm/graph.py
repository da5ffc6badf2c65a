"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (above it if `large`, else below it and itself) are linked to the least around it."""
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        moved = joined.select("b", "root").where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("root").alias("b")))
    return moved.where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))").alias("h")).first()
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of `links` (a, b) is connected with.

    Large-star and small-star steps in turn, each over a written table, until
    nothing moves; a node of many links is never gathered, its minimum is
    reduced before the shuffle. Nodes without links to others do not appear.
    """
    current = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialize(current, "components")
    before, now = None, _state(current)
    while now != before:
        # a large star leaves links from above to below, as a small star takes them
        current = materialize(_star(_star(current, True), False), "components")
        before, now = now, _state(current)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "components")
