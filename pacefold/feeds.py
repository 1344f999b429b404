"""The three message feeds: topic, stored table and schema of each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


@dataclass(frozen=True)
class Feed:
    """One kind of message: where it comes from, where it is stored, its fields.

    ``time_field`` names the field whose day the stored table is partitioned by.
    """

    name: str
    topic: str
    table: str
    schema: StructType
    time_field: str = "timestamp"

    @property
    def stored_schema(self) -> StructType:
        """Fields of the stored table: the ingestion key, then the message fields."""
        return StructType([StructField("id", StringType()), *self.schema.fields])


# Topic names, table names, field names and field types must equal
# those of the existing producers and tables.
READINGS = Feed(
    name="readings",
    topic="fitness-topic",
    table="fitness_data",
    schema=StructType(
        [
            StructField("user_id", StringType()),
            StructField("heart_rate", IntegerType()),
            StructField("steps", IntegerType()),
            StructField("calories", DoubleType()),
            StructField("timestamp", StringType()),
        ]
    ),
)
SUMMARIES = Feed(
    name="summaries",
    topic="daily-summary-topic",
    table="daily_summaries",
    schema=StructType(
        [
            StructField("user_id", StringType()),
            StructField("total_steps", IntegerType()),
            StructField("total_calories", DoubleType()),
            StructField("avg_heart_rate", IntegerType()),
            StructField("date", StringType()),
        ]
    ),
    time_field="date",
)
ALERTS = Feed(
    name="alerts",
    topic="alert-topic",
    table="fitness_alerts",
    schema=StructType(
        [
            StructField("user_id", StringType()),
            StructField("alert_type", StringType()),
            StructField("alert_message", StringType()),
            StructField("timestamp", StringType()),
        ]
    ),
)

FEEDS = (READINGS, SUMMARIES, ALERTS)

#: Storage columns that say which micro-batch wrote a row.
BATCH_COLUMNS = (StructField("writer", StringType()), StructField("batch_id", LongType()))

#: Storage column of the day a row is about; null where it cannot be read.
DAY_COLUMN = StructField("event_date", DateType())

#: Storage column of the part of the id index that an id belongs to.
BUCKET = "bucket"

#: Shape of a raw message as brokers deliver it (extra broker columns are ignored).
ENVELOPE = StructType(
    [
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
    ]
)
