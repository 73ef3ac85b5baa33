"""Server logs as a stream of closed (rotated) log files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticketlake.plans.log_poll import poll_logs
from ticketlake.streaming.landing import stream_batch_id


def stream_logs(
    spark: SparkSession,
    directory: str,
    checkpoint: str,
    events_dir: str,
    glob: str = "*.log",
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Extract the events of each new log file once, with all of its lines.

    The stream lists paths only; each batch reads its files in splits.
    """
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
        .select("path")
    )

    def extract(batch: DataFrame, batch_id: int) -> None:
        # File names only, at most files_per_batch of them.
        paths = [row["path"] for row in batch.collect()]
        if paths:
            poll_logs(
                batch.sparkSession, paths, events_dir, stream_batch_id(batch, batch_id),
                dt.datetime.now().replace(microsecond=0), tail=None, since_mark=False,
            )

    return (
        listing.writeStream.foreachBatch(extract)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
