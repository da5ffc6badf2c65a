"""Change sets between two snapshots, their inverse, and their application.

Rows are compared by digest, so that of rows which did not change only key,
digest and number of copies are shuffled; the rows themselves are fetched for
the digests that did. Snapshots are bags: copies of a row are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.skew import bounded_broadcast
from shelfmark.session import materialize

INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_before", "update_after"
_OPPOSITE = {INSERT: DELETE, DELETE: INSERT, BEFORE: AFTER, AFTER: BEFORE}
#: Changed digests (32 characters each) up to which they are broadcast to the rows.
BROADCAST_DIGESTS = 1_000_000


def digest(columns: list[str]) -> Column:
    """MD5 of a row: each value with its length before it, so no two rows are written alike; NULL apart from empty text."""

    def spelled(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.char_length(text).cast("string"), F.lit(":"), text))

    return F.md5(F.concat(*[spelled(name) for name in columns]))


def _digested(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with their digest, written once.

    A plan would be worked out anew for each pass, and inside a join's key once
    for each time that the digest names a column.
    """
    return materialize(rows.select(*columns, digest(columns).alias("_digest")), "digested")


def _counted(digested: DataFrame, key: str, name: str) -> DataFrame:
    """(key, digest, copies): copies are reduced before the shuffle."""
    return digested.select(F.col(f"`{key}`").alias("_key"), "_digest").groupBy("_key", "_digest").agg(F.count(F.lit(1)).alias(name))


def _fetched(digested: DataFrame, columns: list[str], wanted: DataFrame) -> DataFrame:
    """One row of each wanted digest, with what `wanted` says of it."""
    chosen = digested.join(bounded_broadcast(wanted.select("_digest").distinct(), BROADCAST_DIGESTS), "_digest", "left_semi")
    single = chosen.groupBy("_digest").agg(F.first(F.struct(*columns)).alias("_row"))
    return single.join(wanted, "_digest").select("change", "copies", "_row.*")


def snapshot_changes(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """(change, copies, row...) that turn `old` into `new`; both have the same columns.

    A key of which rows went and came was updated: its old rows are
    `update_before`, its new ones `update_after`. All else is `delete` or
    `insert`, and so are rows without a key. `copies` says how many equal rows a
    line stands for.
    """
    columns = old.columns
    if sorted(columns) != sorted(new.columns):
        raise ValueError("both snapshots must have the same columns")
    old, new = _digested(old, columns), _digested(new, columns)
    was, now = _counted(old, key, "_old"), _counted(new, key, "_new")
    same = was["_key"].eqNullSafe(now["_key"]) & (was["_digest"] == now["_digest"])
    moved = F.coalesce(now["_new"], F.lit(0)) - F.coalesce(was["_old"], F.lit(0))
    differing = was.join(now, same, "full_outer").select(
        F.coalesce(was["_key"], now["_key"]).alias("_key"), F.coalesce(was["_digest"], now["_digest"]).alias("_digest"), moved.alias("_moved")
    )
    differing = materialize(differing.where("_moved != 0"), "changes")
    torn = differing.where("_key IS NOT NULL").groupBy("_key").agg(F.min("_moved").alias("least"), F.max("_moved").alias("most"))
    torn = torn.where("least < 0 AND most > 0").select("_key", F.lit(True).alias("_torn"))
    told = differing.join(torn, "_key", "left").select(
        "_digest",
        F.when(F.col("_moved") > 0, F.when(F.col("_torn"), AFTER).otherwise(INSERT))
        .otherwise(F.when(F.col("_torn"), BEFORE).otherwise(DELETE)).alias("change"),
        F.abs("_moved").alias("copies"),
    )
    told = materialize(told, "changes")
    gone, come = told.where(F.col("change").isin(DELETE, BEFORE)), told.where(F.col("change").isin(INSERT, AFTER))
    return _fetched(old, columns, gone).unionByName(_fetched(new, columns, come))


def inverse(changes: DataFrame) -> DataFrame:
    """The change set that leads back."""
    swapped = F.create_map(*[F.lit(x) for pair in _OPPOSITE.items() for x in pair])
    return changes.withColumn("change", swapped[F.col("change")])


def apply_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """`snapshot` after the changes; a change set that takes away rows which are not there raises.

    Rows that no change names are neither counted nor gathered: the digests that
    lose rows are few, and only their rows are.
    """
    columns = snapshot.columns
    come = changes.where(F.col("change").isin(INSERT, AFTER))
    added = come.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
    gone = changes.where(F.col("change").isin(DELETE, BEFORE)).select(digest(columns).alias("_digest"), "copies")
    gone = materialize(gone.groupBy("_digest").agg(F.sum("copies").alias("_gone")), "changes")
    digested = _digested(snapshot, columns)
    named = bounded_broadcast(gone.select("_digest"), BROADCAST_DIGESTS)
    untouched = digested.join(named, "_digest", "left_anti")
    touched = digested.join(named, "_digest", "left_semi").groupBy("_digest").agg(
        F.first(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_have")
    )
    left = F.coalesce("_have", F.lit(0)) - F.col("_gone")
    rest = gone.join(touched, "_digest", "left").select(
        "_row", F.when(left < 0, F.raise_error(F.lit("a change takes away rows that are not there"))).otherwise(left).alias("_left")
    )
    rest = rest.where("_left > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_left")))).select("_row.*")
    return untouched.select(*columns).unionByName(rest.select(*columns)).unionByName(added)
