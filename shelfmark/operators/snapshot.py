"""Commands on a catalogue snapshot: each takes a frame and returns the next one.

A predicate or value may be a Column or SQL expression text.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.schema import PRODUCER_COLUMNS

VIEW = "eclasses"
_view = Lock()


def _expression(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.expr(value)


def query(snapshot: DataFrame, sql: str) -> DataFrame:
    """Run any SQL over the snapshot, visible as `eclasses` while the text is read and no longer."""
    with _view:
        snapshot.createOrReplaceTempView(VIEW)
        try:
            return snapshot.sparkSession.sql(sql)
        finally:
            snapshot.sparkSession.catalog.dropTempView(VIEW)


def select_rows(snapshot: DataFrame, sql: str) -> DataFrame:
    """Run a row query; its result must carry every catalogue column by name."""
    result = query(snapshot, sql)
    present = {name.lower() for name in result.columns}
    missing = [name for name in PRODUCER_COLUMNS if name not in present]
    if missing:
        raise ValueError(f"query result lacks catalogue columns: {', '.join(missing)}")
    return result.select(*PRODUCER_COLUMNS)


def insert(snapshot: DataFrame, rows: DataFrame) -> DataFrame:
    """Append `rows` by column name; unnamed columns are NULL, types are the snapshot's."""
    extra = [name for name in rows.columns if name not in snapshot.columns]
    if extra:
        raise ValueError(f"no such catalogue columns: {', '.join(extra)}")
    types = {field.name: field.dataType for field in snapshot.schema.fields}
    typed = rows.select(*[F.col(name).cast(types[name]).alias(name) for name in rows.columns])
    return snapshot.unionByName(typed, allowMissingColumns=True)


def update(
    snapshot: DataFrame,
    assignments: dict[str, Column | str],
    where: Column | str = "true",
) -> DataFrame:
    """Set columns where the predicate holds; every value is computed from the old row."""
    types = {field.name: field.dataType for field in snapshot.schema.fields}
    hit = _expression(where)
    changed = {
        name: F.when(hit, _expression(value).cast(types[name])).otherwise(F.col(name))
        for name, value in assignments.items()
    }
    return snapshot.withColumns(changed)


def delete(snapshot: DataFrame, where: Column | str = "true") -> DataFrame:
    """Drop rows where the predicate is true; a NULL outcome keeps the row."""
    return snapshot.where(~F.coalesce(_expression(where), F.lit(False)))


def latest_rows(df: DataFrame, key: str, *newest: str) -> DataFrame:
    """One whole row per key: the one with the greatest `newest` columns, in that order.

    A row without a key is no copy of another, so all such rows are kept. An
    aggregate rather than a window, so that copies of one key are reduced
    before the shuffle and no task holds all of them.
    """
    row = F.max_by(F.struct(*df.columns), F.struct(*newest)).alias("row")
    keyed = df.where(F.col(key).isNotNull()).groupBy(key).agg(row).select("row.*")
    return keyed.unionByName(df.where(F.col(key).isNull()))


def versioned(snapshot: DataFrame, number: int) -> DataFrame:
    """Mark every row with the snapshot it belongs to, so that copies can be told apart."""
    return snapshot.withColumn("snapshot_id", F.lit(number).cast("bigint"))


def latest_snapshot(df: DataFrame, version: str = "snapshot_id") -> DataFrame:
    """All rows of the newest whole snapshot, so rows deleted since do not come back."""
    return df.where(F.col(version) == df.agg(F.max(version)).scalar())
