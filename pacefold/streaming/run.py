"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

#: Process what is there now, in one or more batches, and stop.
AVAILABLE_NOW = {"availableNow": True}


def start_batches(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to a function; an error in it stops the query.

    The checkpoint makes a restart go on where the last batch ended. Without a
    trigger, batches follow each other as fast as they can; on a busy stream give
    an interval, since each batch leaves one folder per table.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def last_watermark(query: StreamingQuery) -> datetime:
    """The event time up to which a query has closed its windows."""
    texts = [
        progress["eventTime"]["watermark"]
        for progress in query.recentProgress
        if "watermark" in progress["eventTime"]
    ]
    if not texts:
        raise ValueError("the query has no watermark")
    return max(datetime.fromisoformat(text) for text in texts).astimezone(UTC)


def run_to_table(stream: DataFrame, root: str) -> DataFrame:
    """Process all available input into a Parquet folder and return its rows."""
    return run_and_watermark(stream, root)[0]


def run_and_watermark(stream: DataFrame, root: str) -> tuple[DataFrame, StreamingQuery]:
    """The same, and the query, which has ended."""
    query = start_table(stream, f"{root}/table", f"{root}/checkpoint", AVAILABLE_NOW)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/table"), query
