"""Reports over readings, or over their totals from :func:`condense`.

All are plain aggregates: Spark combines rows inside the map tasks, so a user or a
day that holds a large share of the readings costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.functions.times import date_text, event_date
from pacefold.functions.totals import ROWS, is_condensed, mean, totals

_ACTIVITY = ("steps", "calories", "heart_rate")


def condense(readings: DataFrame) -> DataFrame:
    """Totals per user and day, which all reports here can be made from."""
    return totals(_with_day(readings), ["user_id", "day"], _ACTIVITY, ("steps", "calories"))


def user_stats(readings: DataFrame) -> DataFrame:
    """Per-user totals, means and maxima, most active users first."""
    per_user = totals(readings, ["user_id"], _ACTIVITY, ("steps", "calories"))
    return per_user.select(
        "user_id",
        F.col(ROWS).alias("total_records"),
        *_activity_means(),
        "max_steps",
        "max_calories",
    ).orderBy(F.desc_nulls_last("avg_steps"), "user_id")


def top_users(readings: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most active users."""
    return user_stats(readings).limit(k)


def daily_trends(readings: DataFrame) -> DataFrame:
    """Per-day means and record counts, oldest day first.

    Groups on the 4-byte date and formats only the grouped rows. Readings whose
    timestamp cannot be read form the null-date group.
    """
    per_day = totals(_with_day(readings), ["day"], _ACTIVITY)
    return per_day.orderBy("day").select(
        date_text(F.col("day")).alias("date"),
        *_activity_means(),
        F.col(ROWS).alias("total_records"),
    )


def batch_user_stats(readings: DataFrame) -> DataFrame:
    """Per-user means of one batch of readings."""
    return totals(readings, ["user_id"], _ACTIVITY).select("user_id", *_activity_means())


def health_snapshot(readings: DataFrame) -> DataFrame:
    """Mean, highest and lowest heart rate; one row, of nulls if there is no input."""
    return readings.agg(
        F.avg("heart_rate").alias("avg_heart_rate"),
        F.max("heart_rate").alias("max_heart_rate"),
        F.min("heart_rate").alias("min_heart_rate"),
    )


def _activity_means() -> list[Column]:
    return [mean(column, f"avg_{column}") for column in _ACTIVITY]


def _with_day(readings: DataFrame) -> DataFrame:
    return readings if is_condensed(readings) else readings.withColumn("day", event_date())
