"""Message topics: where raw messages come from, and decoding them to typed rows.

A topic source is a function ``(spark, topic) -> DataFrame`` of raw messages with
at least ``value`` and ``topic``. The same decoding serves streams and batches. Broker
topics and files also give ``arrival``, when a message came in, and what tells it from
every other: the broker's ``partition`` and ``offset``, or else its ``position``, the
file and row it was read from.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.feeds import ENVELOPE, FEEDS, Feed
from pacefold.functions.payloads import decode, decode_grade, decode_with_raw, payload_text
from pacefold.operators.dedup import dedup_stream

TopicSource = Callable[[SparkSession, str], DataFrame]


def kafka_source(
    bootstrap_servers: str, max_offsets_per_trigger: int | None = None, **options: str
) -> TopicSource:
    """Streaming Kafka topics, from the earliest offset on the first start.

    Needs the ``spark-sql-kafka-0-10`` package on the class path. Set
    ``max_offsets_per_trigger`` so that the first batch does not take the whole
    backlog.
    """

    def open_topic(spark: SparkSession, topic: str) -> DataFrame:
        return (
            spark.readStream.format("kafka")
            .options(**kafka_options(bootstrap_servers, topic, max_offsets_per_trigger))
            .options(**options)
            .load()
            .withColumnRenamed("timestamp", "arrival")
        )

    return open_topic


def kafka_options(
    bootstrap_servers: str, topic: str, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def file_source(
    root: str, file_format: str = "parquet", spread: bool = False, **options: str
) -> TopicSource:
    """Streaming topics stored as files, one folder per topic under ``root``.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch. Only Parquet
    files number their rows: messages in other formats have no ``position``.

    A Parquet file is read by as many tasks as it has row groups, often one. ``spread``
    deals its messages to more tasks before they are decoded: for micro-batches of a few
    large files. Small ones stay together where the session is adaptive.
    """

    def open_topic(spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.readStream.schema(ENVELOPE).format(file_format).options(**options)
        messages = _placed(reader.load(f"{root}/{topic}"), file_format)
        return messages.repartition("position") if spread and file_format == "parquet" else messages

    return open_topic


def file_batch(root: str, file_format: str = "parquet", **options: str) -> TopicSource:
    """The same stored topics, read once as a batch."""

    def open_topic(spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.read.schema(ENVELOPE).format(file_format).options(**options)
        return _placed(reader.load(f"{root}/{topic}"), file_format)

    return open_topic


def _placed(messages: DataFrame, file_format: str) -> DataFrame:
    """Messages of files with the row they were read from and the file's time."""
    position = F.lit(None).cast("string")
    if file_format == "parquet":
        position = F.concat_ws(
            ":", F.md5(F.col("_metadata.file_path").cast("binary")), "_metadata.row_index"
        )
    return messages.select(
        *ENVELOPE.fieldNames(),
        position.alias("position"),
        F.col("_metadata.file_modification_time").alias("arrival"),
    )


def deduplicated(source: TopicSource, delay: str = "1 hour", salt: int = 16) -> TopicSource:
    """A streaming source that hands out each message once, across micro-batches.

    Copies are recognised by the message's id for ``delay`` after the query first saw it.
    No time of the message or its broker plays a part: a message that comes late, in a
    file of yesterday or from a partition that lags behind, is handed out like any other.
    Copies that come after the delay are too; :class:`pacefold.sinks.ids.IdIndex` knows
    those as well.
    """

    def open_topic(spark: SparkSession, topic: str) -> DataFrame:
        messages = source(spark, topic)
        # The time of the micro-batch never falls behind the watermark made from it.
        seen = messages.withColumns({"id": message_id(messages), "seen": F.current_timestamp()})
        return dedup_stream(seen.withWatermark("seen", delay), ["id"], salt)

    return open_topic


def read_topic(spark: SparkSession, feed: Feed, source: TopicSource) -> DataFrame:
    """Typed rows of one feed from its topic."""
    return decode_messages(source(spark, feed.topic), feed)


def decode_messages(messages: DataFrame, feed: Feed, graded: bool = False) -> DataFrame:
    """Raw messages of a feed's topic to ``id``, its fields and ``topic``.

    Messages that cannot be decoded stay, with null fields. With ``graded`` they also
    have a ``grade`` and their text as ``value``, from the same decoding; both are null
    for good messages. ``id`` is there if the messages have positions or ids.
    """
    own = messages.where(F.col("topic") == feed.topic)
    key = [message_id(messages).alias("id")] if _identified(messages) else []
    names = ["id"] if key else []
    topic = F.lit(feed.topic).alias("topic")
    fields = [f"data.{name}" for name in feed.schema.fieldNames()]
    if not graded:
        return own.select(*key, decode(feed.schema).alias("data")).select(*names, *fields, topic)
    data = F.col("data")
    return (
        own.select(*key, payload_text().alias("value"), decode_with_raw(feed.schema).alias("data"))
        .select(*names, "value", "data", decode_grade(data, feed.schema).alias("grade"))
        .select(
            *names, *fields, topic, "grade", F.when(F.col("grade").isNotNull(), F.col("value")).alias("value")
        )
    )


def _identified(messages: DataFrame) -> bool:
    names = set(messages.columns)
    return "id" in names or "position" in names or {"partition", "offset"} <= names


def message_id(messages: DataFrame) -> Column:
    """What tells a message from all others, the same on every replay.

    Topic and broker position, or topic and place in a file; null where neither is known.
    """
    names = set(messages.columns)
    if "id" in names:
        return F.col("id")
    mark = F.lit(":")
    ways = []
    if {"partition", "offset"} <= names:
        ways.append(F.concat("topic", mark, "partition", mark, "offset"))
    if "position" in names:
        ways.append(F.concat("topic", mark, "position"))
    return F.coalesce(*ways)


def combined_stream(
    spark: SparkSession,
    source: TopicSource,
    feeds: tuple[Feed, ...] = FEEDS,
    graded: bool = False,
) -> DataFrame:
    """All feeds in one frame, matched by column name; foreign fields are null."""
    return union_feeds(
        [decode_messages(source(spark, feed.topic), feed, graded) for feed in feeds]
    )


def union_feeds(frames: list[DataFrame]) -> DataFrame:
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )


def quarantine(messages: DataFrame, feed: Feed) -> DataFrame:
    """Messages of a topic that could not be decoded, wholly or in part."""
    return quarantined(decode_messages(messages, feed, graded=True))


def quarantined(graded: DataFrame) -> DataFrame:
    """The same from decoded rows with their grades; ``id`` leads to the stored row."""
    names = [n for n in ("id", "value", "topic", "grade") if n in graded.columns]
    return graded.where(F.col("grade").isNotNull()).select(*names)
