"""The most frequent terms without a shuffle of all terms.

A term's name is the first 64 bits of its MD5. Counts by name need 16 bytes per
distinct term and task in the shuffle, whatever the terms' length, and bound the
count of every term that bears the name. The names at the edge of the wanted
number follow from two histograms; only terms of names inside it are then
counted as text. Names that several terms share are found by that count, and
the edge is moved until no term left out can reach it: the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.grams import gram_parts
from shelfmark.operators.skew import bounded_broadcast
from shelfmark.operators.terms import VOCABULARY_SIZE, _edge
from shelfmark.session import materialize

#: Names (8 bytes each) up to which they are broadcast to the rows.
BROADCAST_NAMES = 8_000_000
_SIGN = 1 << 63


def name_of(term: Column) -> Column:
    """The first 64 bits of the term's MD5 as a long that sorts as the digest does."""
    # the sign bit is turned, so that signed order is that of the digest
    return F.conv(F.substring(F.md5(term), 1, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-_SIGN).cast("long"))


def _named_counts(df: DataFrame, terms: str, n: int) -> DataFrame:
    """(name, bound): occurrences of all terms of a name; dealt by name at once, since most occur once."""
    rows = gram_parts(df, terms, n).select(name_of(F.col("term")).alias("name"), "cf")
    return rows.repartition("name").groupBy("name").agg(F.sum("cf").alias("bound"))


def _range(name: Column) -> Column:
    """The digest's first 24 bits, in order."""
    return F.shiftright(name, 40).cast("int")


def _leading(named: DataFrame, size: int) -> DataFrame:
    """At least the first `size` names by falling bound, then name; at most one digest range more."""
    count = F.count(F.lit(1)).alias("n")
    edge = _edge(named.groupBy(F.col("bound").alias("bin")).agg(count), F.desc("bin"), size)
    if edge is None:
        return named
    least, room = edge
    tied = F.col("bound") == least
    found = _edge_of_ranges(named.where(tied).groupBy(_range(F.col("name")).alias("bin")).agg(count), room)
    return named.where((F.col("bound") > least) | (tied & (_range(F.col("name")) <= found)))


def _edge_of_ranges(histogram: DataFrame, room: int) -> int:
    """The range in which the running count reaches `room`: first by coarse ranges, then inside one."""
    coarse = histogram.groupBy(F.shiftright("bin", 12).alias("bin")).agg(F.sum("n").alias("n"))
    part, rest = _edge(coarse, F.asc("bin"), room)
    return _edge(histogram.where(F.shiftright("bin", 12) == part), F.asc("bin"), rest)[0]


def _counted_terms(df: DataFrame, terms: str, names: DataFrame, n: int) -> DataFrame:
    """(term, cf, df, name) of the terms whose name is among `names`."""
    rows = gram_parts(df, terms, n).withColumn("name", name_of(F.col("term")))
    chosen = rows.join(bounded_broadcast(names.select("name"), BROADCAST_NAMES), "name", "left_semi")
    return chosen.groupBy("name", "term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def top_terms(df: DataFrame, terms: str, size: int = VOCABULARY_SIZE, n: int = 1) -> DataFrame:
    """(term, cf, df, rank): the `size` terms of highest count, ties by MD5, then term; ranks from 0.

    The terms are the windows of `n` neighbouring words of the column.

    Two passes over the texts in place of a shuffle of them. `df` is read twice,
    so give a table or a narrow plan over one.
    """
    named = materialize(_named_counts(df, terms, n), "term-names")
    names = materialize(_leading(named, size), "term-names")
    found = materialize(_counted_terms(df, terms, names, n), "leaders")
    order = [F.desc("cf"), F.asc(F.md5("term")), F.asc("term")]
    rank = F.row_number().over(Window.orderBy(*order)) - 1
    ranked = found.withColumn("rank", rank).where(F.col("rank") < size)
    if found.groupBy("name").count().where("count > 1").limit(1).count():
        # several terms shared a name, so its bound was too high: what can reach the real edge is counted too
        last = ranked.orderBy(F.desc("rank")).first()
        reach = (F.col("bound") > last["cf"]) | ((F.col("bound") == last["cf"]) & (F.col("name") <= last["name"]))
        more = named.where(reach) if last["rank"] == size - 1 else named
        found = materialize(_counted_terms(df, terms, more, n), "leaders")
        ranked = found.withColumn("rank", rank).where(F.col("rank") < size)
    return ranked.select("term", "cf", "df", "rank")
