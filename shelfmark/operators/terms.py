"""Term statistics over an array column of terms, as long tables.

Every function takes the frame and the name of its term-array column; with `n`
the column holds words, and the terms are windows of `n` of them. Counting
inside a row is local (see `operators.grams`), so the only shuffles are one
aggregation by term and, for an unbounded TF-IDF, one dealing of the terms (of
n-grams as runs of words, see `operators.runs`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfmark.operators.grams import gram_counts, gram_stats
from shelfmark.operators.runs import gram_rows
from shelfmark.operators.skew import salted_lookup
from shelfmark.session import materialize

VOCABULARY_SIZE = 1 << 18

# A vocabulary is broadcast only when its measured text is below this.
BROADCAST_BYTES = 256 << 20


def term_rows(df: DataFrame, key: str, terms: str) -> DataFrame:
    """(key, pos, term): one row per term, in order, from 0.

    The outer form, then a filter: from the inner form the optimizer infers a
    test of the array's size and pushes it to the scan, which computes every
    array twice.
    """
    exploded = df.select(key, F.posexplode_outer(terms).alias("pos", "term"))
    return exploded.where(F.col("pos").isNotNull())


def term_counts(df: DataFrame, key: str, terms: str, min_tf: float = 1, n: int = 1) -> DataFrame:
    """(key, term, tf) per input row; no shuffle. `min_tf` leaves out what is rare in its row: a count, or a share if below 1."""
    return gram_counts(df, key, terms, n, min_tf)


def term_stats(df: DataFrame, terms: str, n: int = 1) -> DataFrame:
    """(term, cf, df): occurrences and rows per term, in one shuffle."""
    return gram_stats(df, terms, n)


def frequent(stats: DataFrame, min_df: float, rows: int | None = None) -> DataFrame:
    """The terms that at least `min_df` rows hold: a number of rows, or a share of `rows` if below 1."""
    if min_df < 1 and rows is None:
        raise ValueError("a share needs the number of rows")
    return stats.where(F.col("df") >= (min_df if min_df >= 1 else min_df * rows))


def doc_freq(df: DataFrame, terms: str, n: int = 1) -> DataFrame:
    """(term, df) alone."""
    return gram_stats(df, terms, n).select("term", "df")


def _leading(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """The first `size` rows of every partition: a narrow step that keeps any global top `size`."""
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.sortWithinPartitions(*order).where(position < size)


def _edge(histogram: DataFrame, order: Column, size: int) -> tuple[int, int] | None:
    """The bin in which the running total of `n` reaches `size`, and the room left in that bin.

    The histogram has one row per distinct count (at most the square root of
    twice the occurrences) or one per digest range, so one task can total it.
    """
    running = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    row = (
        histogram.withColumn("upto", F.sum("n").over(running))
        .where(F.col("upto") >= size)
        .orderBy("upto")
        .first()
    )
    return None if row is None else (row["bin"], size - row["upto"] + row["n"])


def vocabulary(stats: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The `size` terms with the highest corpus count, ranked from 0.

    Ties are ordered by MD5 of the term, then the term. The terms are neither
    sorted globally nor sent to one task: every partition of `stats` keeps its
    own first `size` and writes them; on that table a histogram of counts finds
    the count at the edge, one of digest ranges finds where the tied terms are
    cut, and only what lies inside (at most `size` plus one digest range) is
    ranked. Terms that occur once, the most by far, are neither sorted nor
    written if the others fill the vocabulary.
    """
    order = [F.desc("cf"), F.asc("digest"), F.asc("term")]
    digested = stats.withColumn("digest", F.md5("term"))
    leaders = materialize(_leading(digested.where("cf > 1"), order, size), "leaders")
    if leaders.count() < size:
        leaders = materialize(_leading(digested, order, size), "leaders")

    count = F.count(F.lit(1)).alias("n")
    edge = _edge(leaders.groupBy(F.col("cf").alias("bin")).agg(count), F.desc("bin"), size)
    inside = leaders
    if edge:
        least, room = edge
        tied = F.col("cf") == least
        range_ = F.conv(F.substring("digest", 1, 4), 16, 10).cast("int")
        ranges = leaders.where(tied).groupBy(range_.alias("bin")).agg(count)
        last, _ = _edge(ranges, F.asc("bin"), room)
        inside = leaders.where((F.col("cf") > least) | (tied & (range_ <= last)))
    rank = F.row_number().over(Window.orderBy(*order)) - 1
    return inside.withColumn("rank", rank).where(F.col("rank") < size).drop("digest")


def with_doc_freq(counts: DataFrame) -> DataFrame:
    """`counts` (one row per term of each row) and `df`, the number of rows that hold the term, from one dealing by term."""
    # by a hash first: two texts are then hardly ever compared
    dealt = counts.repartition("term").withColumn("_hash", F.xxhash64("term"))
    return dealt.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("_hash", "term"))).drop("_hash")


def idf(rows: Column, containing: Column) -> Column:
    return F.log((rows + 1.0) / (containing + 1.0))


def tfidf(
    df: DataFrame,
    key: str,
    terms: str,
    vocabulary_size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    min_df: float = 1,
    min_tf: float = 1,
    min_doc_freq: int = 0,
    n: int = 1,
) -> DataFrame:
    """(key, term, tf, df, tfidf) with tfidf = tf * ln((rows + 1) / (df + 1)).

    All rows count, also those without terms. With `vocabulary_size` only the
    vocabulary's terms are kept; that table is measured and, if it fits, the
    term counts are never shuffled. `min_df` leaves out terms of few rows,
    `min_tf` terms that are rare in their row (each a number, or a share if
    below 1), and terms of fewer than `min_doc_freq` rows weigh nothing.

    Words are few and some very frequent: their rows are counted first, and the
    counts joined to that by pieces. N-grams are many and mostly rare; they are
    dealt once, as runs of words, and the rows of a term are counted where they
    lie. A term is dealt once a row at most, so its share of all is no more than
    that of a few terms of a row of average length.
    """
    counts = term_counts(df, key, terms, min_tf, n)
    total = df.count() if min_df < 1 else None
    if vocabulary_size is None and n > 1 and min_tf == 1:
        joined = frequent(gram_rows(df, key, terms, n), min_df, total)
    elif vocabulary_size is None:
        # written once: the total, the heavy keys and the join all read it
        facts = materialize(frequent(doc_freq(df, terms, n), min_df, total), "doc-freq")
        joined = salted_lookup(counts, facts, "term", "df", key)
    else:
        stats = frequent(term_stats(df, terms, n), min_df, total)
        kept = materialize(vocabulary(stats, vocabulary_size), "vocabulary").select("term", "df")
        size = kept.agg(F.sum(F.octet_length("term"))).first()[0] or 0
        if size <= broadcast_bytes:
            joined = counts.join(F.broadcast(kept), "term")
        else:
            joined = salted_lookup(counts, kept, "term", "df", key)
    rows = df.agg(F.count(F.lit(1))).scalar()
    weight = idf(rows, F.col("df"))
    if min_doc_freq:
        weight = F.when(F.col("df") >= min_doc_freq, weight).otherwise(0.0)
    return joined.select(key, "term", "tf", "df", (F.col("tf") * weight).alias("tfidf"))
