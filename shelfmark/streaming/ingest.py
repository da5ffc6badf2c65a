"""Line records in, one parquet folder per micro-batch out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.codec import parse_lines

EVERY = "5 seconds"


def batch_writer(root: str):
    """A batch function; a batch that is replayed replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_{batch_id}")

    return write


def start_ingest(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = EVERY,
) -> StreamingQuery:
    """Parse `value`, keep `timestamp`, and start writing batches under `root`.

    `checkpoint` must outlive the run: it makes a restart go on after the last
    whole batch instead of at the first record. With `every=None` the query
    takes what is there and ends.
    """
    writer = (
        parse_lines(lines, keep=("timestamp",))
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(root))
    )
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def ingest_available(lines: DataFrame, root: str, checkpoint: str) -> None:
    """Ingest all that is there and return when the last batch is written."""
    start_ingest(lines, root, checkpoint, every=None).awaitTermination()
