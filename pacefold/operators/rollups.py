"""Roll-ups of raw readings to days and hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.feeds import SUMMARIES
from pacefold.functions.measures import measures, row_count
from pacefold.functions.times import date_text, ensure_event_time


def _summary_measures() -> list[Column]:
    # total_steps stays 64-bit: a busy user-day must not overflow the job.
    return [
        *measures(F.sum, total_steps="steps", total_calories="calories"),
        F.round(F.avg("heart_rate")).cast("int").alias("avg_heart_rate"),
    ]


def daily_summary_rollup(readings: DataFrame) -> DataFrame:
    """Readings to daily summaries, one row per user and day.

    Readings without a readable time form the null-date group of their user.
    """
    return (
        ensure_event_time(readings)
        .groupBy("user_id", F.to_date("event_time").alias("day"))
        .agg(*_summary_measures())
        .withColumn("date", date_text(F.col("day")))
        .select(*SUMMARIES.schema.fieldNames())
    )


def daily_summary_windows(readings: DataFrame) -> DataFrame:
    """The same roll-up over one-day windows, for streams with a watermark.

    A stream emits a user-day once the watermark has passed its end. Readings
    without a readable time belong to no window and are left out.
    """
    return (
        ensure_event_time(readings)
        .groupBy("user_id", F.window("event_time", "1 day").alias("day"))
        .agg(*_summary_measures())
        .withColumn("date", date_text(F.col("day.start")))
        .select(*SUMMARIES.schema.fieldNames())
    )


def periodic_user_stats(readings: DataFrame, period: str = "1 hour") -> DataFrame:
    """Per user and period: number of readings and mean heart rate (batch or stream)."""
    return (
        ensure_event_time(readings)
        .groupBy("user_id", F.window("event_time", period).alias("period"))
        .agg(
            row_count("readings"),
            *measures(F.avg, avg_heart_rate="heart_rate"),
        )
        .select(
            "user_id",
            F.col("period.start").alias("window_start"),
            "readings",
            "avg_heart_rate",
        )
    )
