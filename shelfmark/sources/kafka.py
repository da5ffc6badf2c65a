"""Topic reader; needs the Kafka connector on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def subscribe_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; the last two bound a batch and split a topic with few partitions."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def topic_stream(spark: SparkSession, servers: str, topic: str, **limits) -> DataFrame:
    """`value` and `timestamp` of every record of `topic`, as a stream."""
    options = subscribe_options(servers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load().select("value", "timestamp")
