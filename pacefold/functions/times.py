"""Column functions over the text timestamps that messages carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text formats of the message fields.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def event_time(text: Column | str = "timestamp") -> Column:
    """Parse a message timestamp; unreadable text gives null instead of an error."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def event_date(text: Column | str = "timestamp") -> Column:
    """Calendar date of a message timestamp, as a 4-byte date (cheap grouping key)."""
    return F.to_date(event_time(text))


def timestamp_text(time: Column) -> Column:
    return F.date_format(time, TIMESTAMP_FORMAT)


def date_text(date: Column) -> Column:
    return F.date_format(date, DATE_FORMAT)


def with_event_time(frame: DataFrame, delay: str | None = None) -> DataFrame:
    """Add ``event_time``; on streams ``delay`` sets the watermark on it."""
    timed = frame.withColumn("event_time", event_time())
    return timed.withWatermark("event_time", delay) if delay else timed


def ensure_event_time(frame: DataFrame) -> DataFrame:
    """Add ``event_time`` unless the caller (for example a stream) already did."""
    return frame if "event_time" in frame.columns else with_event_time(frame)
