"""Equi-join of a large table with per-key facts when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` marked for broadcast if it has at most `max_rows` rows, else as it is; the caller joins either form alike."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def salted_lookup(
    rows: DataFrame,
    facts: DataFrame,
    on: str,
    weight: str,
    spread_by: str,
    partitions: int | None = None,
) -> DataFrame:
    """Inner join `rows` to `facts` (one row per `on`) without an oversized key.

    `weight` is the number of `rows` that carry the key. With W rows in all and
    P partitions, a key heavier than W/4P is cut into ceil(weight / (W/4P))
    pieces: its facts are repeated once per piece and its rows are dealt to
    the pieces by a hash of `spread_by`. The cuts sum to at most 8P, so both the
    repeated facts and the broadcast list of heavy keys have that bound. The
    broadcast list holds 64-bit hashes, not keys, hence its bytes are bounded as
    well; a hash collision only cuts a light key needlessly.
    """
    spark = rows.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = facts.agg((F.sum(weight) / (4 * parts)).alias("share"))
    share = total.scalar()

    heavy = (
        facts.where(F.col(weight) > share)
        .select(
            F.xxhash64(on).alias("_hash"),
            F.ceil(F.col(weight) / share).cast("int").alias("_pieces"),
        )
        .groupBy("_hash")
        .agg(F.max("_pieces").alias("_pieces"))
    )
    heavy = F.broadcast(heavy)

    pieces = F.coalesce("_pieces", F.lit(1))
    dealt = (
        rows.withColumn("_hash", F.xxhash64(on))
        .join(heavy, "_hash", "left")
        .withColumn("_piece", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
        .drop("_hash", "_pieces")
    )
    repeated = (
        facts.withColumn("_hash", F.xxhash64(on))
        .join(heavy, "_hash", "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_hash", "_pieces")
    )
    # Sort-merge by request: the planner cannot see how far an explode has grown
    # either side, and would broadcast one on the size of its input files.
    return dealt.join(repeated.hint("merge"), [on, "_piece"]).drop("_piece")
