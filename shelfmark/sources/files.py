"""Text and parquet readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schema import CATALOGUE


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """`value`: one row per line; `\\n`, `\\r` and `\\r\\n` all end a line."""
    return spark.read.text(path)


def parquet_table(spark: SparkSession, path: str, schema: T.StructType = CATALOGUE) -> DataFrame:
    """Parquet under a declared schema: other columns are not read, absent ones are NULL."""
    return spark.read.schema(schema).parquet(path)


def read_batch(
    spark: SparkSession,
    root: str,
    batch: int | None = None,
    schema: T.StructType = CATALOGUE,
) -> DataFrame:
    """The rows of one ingested micro-batch, or of all of them.

    With `schema.STAMPED` the record time comes along, which tells copies of a
    row from overlapping snapshots apart.
    """
    name = "*" if batch is None else str(batch)
    return parquet_table(spark, f"{root}/batch_{name}", schema)


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of files as they arrive, with the columns a topic would have.

    `timestamp` is the file's modification time.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("timestamp")
    )


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out when a scan has fewer splits than the cluster has cores.

    A large table already has more splits than cores and is returned as is.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
