"""Alerts and activity sessions derived from readings.

Every threshold is a parameter. No operator orders one user's raw readings in a
single task: readings are first combined per user and time slot inside the map
tasks, and only the slots, whose number depends on the time span and not on the
number of readings, are ordered per user.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pacefold.feeds import ALERTS
from pacefold.functions.measures import row_count
from pacefold.functions.messages import (
    GOAL_ACHIEVED,
    HIGH_HEART_RATE,
    LOW_ACTIVITY,
    alert_message,
)
from pacefold.functions.times import date_text, ensure_event_time, timestamp_text


def as_alerts(frame: DataFrame, alert_type: str) -> DataFrame:
    """Rows with ``user_id`` and ``timestamp`` as alert messages of one type."""
    return (
        frame.withColumn("alert_type", F.lit(alert_type))
        .withColumn("alert_message", alert_message(F.col("alert_type")))
        .select(*ALERTS.schema.fieldNames())
    )


def high_heart_rate_alerts(readings: DataFrame, limit: int = 100) -> DataFrame:
    """One alert per reading above the limit (batch or stream)."""
    return as_alerts(readings.where(F.col("heart_rate") > limit), HIGH_HEART_RATE)


def activity_sessions(readings: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Runs of readings of a user without a pause longer than the gap.

    ``session_end`` is the last reading plus the gap, as in Spark's session
    windows; :func:`stream_sessions` is the streaming form.
    """
    by_time = Window.partitionBy("user_id").orderBy("slot")
    starts = F.col("first") > F.lag("last").over(by_time) + _seconds(gap_seconds)
    return (
        _slots(readings, gap_seconds)
        .withColumn("starts", F.coalesce(starts, F.lit(True)).cast("int"))
        .withColumn("session", F.sum("starts").over(by_time))
        .groupBy("user_id", "session")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + _seconds(gap_seconds)).alias("session_end"),
            F.sum("readings").alias("readings"),
        )
        .drop("session")
    )


def stream_sessions(readings: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Activity sessions with Spark's session windows, for streams with a watermark."""
    return (
        ensure_event_time(readings)
        .groupBy("user_id", F.session_window("event_time", f"{gap_seconds} seconds"))
        .agg(row_count("readings"))
        .select(
            "user_id",
            F.col("session_window.start").alias("session_start"),
            F.col("session_window.end").alias("session_end"),
            "readings",
        )
    )


def low_activity_gaps(
    readings: DataFrame, gap_seconds: int = 3600, as_of: datetime | None = None
) -> DataFrame:
    """Pauses longer than the gap: the last reading before and the first after.

    Two readings in one gap-long slot are never more than the gap apart, so each
    pause lies between the last reading of a slot and the first of the user's
    next slot. With ``as_of``, users without a reading in the gap before that time
    have a pause too, whose ``next_time`` is null.
    """
    following = F.lead("first").over(Window.partitionBy("user_id").orderBy("slot"))
    until = F.coalesce("next_time", F.lit(as_of).cast("timestamp"))
    return (
        _slots(readings, gap_seconds)
        .select("user_id", F.col("last").alias("time"), following.alias("next_time"))
        .where(until > F.col("time") + _seconds(gap_seconds))
    )


def low_activity_alerts(
    readings: DataFrame, gap_seconds: int = 3600, as_of: datetime | None = None
) -> DataFrame:
    """One alert per pause, at the last reading before it."""
    gaps = low_activity_gaps(readings, gap_seconds, as_of)
    return as_alerts(_at_time(gaps), LOW_ACTIVITY)


def goal_alerts(readings: DataFrame, goal: int = 10000) -> DataFrame:
    """One alert per user and day that met the step goal."""
    return as_alerts(_at_time(goals_achieved(readings, goal)), GOAL_ACHIEVED)


def derived_alerts(
    readings: DataFrame,
    limit: int = 100,
    gap_seconds: int = 3600,
    goal: int = 10000,
    as_of: datetime | None = None,
) -> DataFrame:
    """All alerts that readings give rise to, as rows of the alert feed."""
    return (
        high_heart_rate_alerts(readings, limit)
        .unionByName(low_activity_alerts(readings, gap_seconds, as_of))
        .unionByName(goal_alerts(readings, goal))
    )


def _at_time(events: DataFrame) -> DataFrame:
    return events.select("user_id", timestamp_text(F.col("time")).alias("timestamp"))


def stream_low_activity(sessions: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Low-activity events of a stream: every closed session ended in a pause."""
    return sessions.select(
        "user_id", (F.col("session_end") - _seconds(gap_seconds)).alias("time")
    )


def goals_achieved(readings: DataFrame, goal: int = 10000) -> DataFrame:
    """Per user and day, the second in which the running step count met the goal.

    Steps are summed per second first, the resolution of message timestamps, so
    ordering one user-day handles at most 86,400 rows however many readings it has.
    """
    second = F.date_trunc("second", "event_time")
    running = (
        Window.partitionBy("user_id", "day")
        .orderBy("second")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ensure_event_time(readings)
        .groupBy("user_id", second.alias("second"))
        .agg(F.sum("steps").alias("steps"))
        .withColumn("day", F.to_date("second"))
        .withColumn("steps_so_far", F.sum("steps").over(running))
        .where(F.col("steps_so_far") >= goal)
        .groupBy("user_id", "day")
        .agg(F.min("second").alias("time"))
        .where(F.col("time").isNotNull())
        .select("user_id", date_text(F.col("day")).alias("date"), "time")
    )


def _seconds(count: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(count))


def _slots(readings: DataFrame, slot_seconds: int) -> DataFrame:
    """First and last reading and their number, per user and time slot.

    Readings without a readable time are left out after the aggregation: a filter
    on the time itself would make Spark parse it twice.
    """
    micros = F.unix_micros("event_time")
    slot = micros - F.pmod(micros, F.lit(slot_seconds * 1_000_000))
    return (
        ensure_event_time(readings)
        .groupBy("user_id", slot.alias("slot"))
        .agg(
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
            row_count("readings"),
        )
        .where(F.col("first").isNotNull())
    )
