"""Publishing typed rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.feeds import Feed
from pacefold.functions.payloads import encode


def encode_messages(rows: DataFrame, feed: Feed) -> DataFrame:
    """Rows of a feed as messages: ``value`` (JSON) and ``topic``.

    Broker positions (``partition``, ``offset``), if the rows have them, are kept.
    """
    positions = [name for name in ("partition", "offset") if name in rows.columns]
    return rows.select(
        encode(*feed.schema.fieldNames()).alias("value"),
        F.lit(feed.topic).alias("topic"),
        *positions,
    )


def publish_to_kafka(
    rows: DataFrame, feed: Feed, bootstrap_servers: str, **options: str
) -> None:
    """Publish rows of a feed to its Kafka topic, without a message key."""
    (
        encode_messages(rows, feed)
        .select("value", "topic")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .options(**options)
        .save()
    )


def publish_to_files(
    rows: DataFrame, feed: Feed, root: str, file_format: str = "parquet"
) -> None:
    """Append rows of a feed as message files to the topic's folder."""
    (
        encode_messages(rows, feed)
        .write.mode("append")
        .format(file_format)
        .save(f"{root}/{feed.topic}")
    )
