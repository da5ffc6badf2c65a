"""A catalogue snapshot as text lines or topic records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.codec import decode_nulls, encode_csv_safe, encode_lines, line_of, trimmed
from shelfmark.schema import COLUMNS


def text_dump(lines: DataFrame, path: str) -> None:
    """Replace `path` with one text line per `value`."""
    lines.select("value").write.mode("overwrite").text(path)


def records(lines: DataFrame) -> DataFrame:
    """(key, value) with no key and the trimmed line."""
    return lines.select(
        F.lit(None).cast("string").alias("key"), trimmed(F.col("value")).alias("value")
    )


def snapshot_records(
    snapshot: DataFrame, columns: list[str] = COLUMNS, quoted: bool = False
) -> DataFrame:
    """Decode, encode and trim a whole snapshot in one narrow plan.

    `quoted` writes CSV that survives commas and line breaks and skips the
    null rules and the trim, which would change values.
    """
    if quoted:
        return encode_csv_safe(snapshot, columns).select(
            F.lit(None).cast("string").alias("key"), "value"
        )
    return records(encode_lines(decode_nulls(snapshot), columns))


def change_records(changes: DataFrame, columns: list[str] = COLUMNS, key: str = "id") -> DataFrame:
    """(key, value) of a change set: the line of each new row under its key, and no value for a key whose row went.

    Only what changed is sent. The key of a record is the row's own, so a reader
    can keep the newest record of each; keys are therefore taken as unique. Rows
    without a key are sent when they come, and cannot be taken back.
    """
    came = changes.where("change IN ('insert', 'update_after')").select(F.col(key).cast("string").alias("key"), *columns)
    lines = decode_nulls(came).select("key", trimmed(line_of(columns)).alias("value"))
    gone = changes.where(F.col(key).isNotNull() & (F.col("change") == "delete"))
    return lines.unionByName(gone.select(F.col(key).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))


def publish(records_: DataFrame, servers: str, topic: str) -> None:
    """Send records to a topic; needs the Kafka connector on the class path."""
    (
        records_.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
