"""Comparing two streams while both run: the readings' days and the summaries told.

Both sides are rolled up to one row per user and day by windows with watermarks, then
joined in full on user and window. A user-day is emitted once, when the watermarks of both
have passed its end; until then it is state, and so the state holds the open days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.functions.times import date_text, ensure_event_time, event_time
from pacefold.operators.reconcile import same_value

#: Columns of a summary that are compared, and whether they are doubles.
_VALUES = {"total_steps": False, "total_calories": True, "avg_heart_rate": False}


def rolled_readings(readings: DataFrame) -> DataFrame:
    """Days from a stream of readings with a watermark."""
    return _per_day(
        ensure_event_time(readings),
        F.sum("steps").alias("total_steps"),
        F.sum("calories").alias("total_calories"),
        F.round(F.avg("heart_rate")).cast("int").alias("avg_heart_rate"),
    )


def told_summaries(summaries: DataFrame) -> DataFrame:
    """Days from a stream of summaries with a watermark; of several, the largest counts."""
    return _per_day(ensure_event_time(summaries), *(F.max(name).alias(name) for name in _VALUES))


def with_summary_time(summaries: DataFrame, delay: str) -> DataFrame:
    """Summaries with the ``event_time`` of their day's beginning, and a watermark on it."""
    return summaries.withColumn("event_time", event_time("date")).withWatermark("event_time", delay)


def _per_day(timed: DataFrame, *measures: Column) -> DataFrame:
    # Keys of a join cannot be null-safe on streams: a missing user is a text of its own.
    user = F.to_json(F.struct("user_id")).alias("user")
    return timed.groupBy(user, F.window("event_time", "1 day").alias("day")).agg(*measures)


def stream_compare(readings: DataFrame, summaries: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Closed user-days of both streams with both sides' values and a ``matches`` flag."""
    left = rolled_readings(readings).select(
        F.col("user").alias("r_user"), F.col("day").alias("r_day"),
        *(F.col(name).alias(f"readings_{name}") for name in _VALUES), F.lit(True).alias("in_readings"),
    )
    right = told_summaries(summaries).select(
        F.col("user").alias("s_user"), F.col("day").alias("s_day"),
        *(F.col(name).alias(f"summaries_{name}") for name in _VALUES), F.lit(True).alias("in_summaries"),
    )
    joined = left.join(right, F.expr("r_user = s_user AND r_day = s_day"), "full_outer")
    same = F.col("in_readings").isNotNull() & F.col("in_summaries").isNotNull()
    for name, is_double in _VALUES.items():
        same &= same_value(F.col(f"readings_{name}"), F.col(f"summaries_{name}"), is_double, tolerance)
    user = F.from_json(F.coalesce("r_user", "s_user"), "user_id string")["user_id"]
    return joined.select(
        user.alias("user_id"),
        date_text(F.coalesce("r_day.start", "s_day.start")).alias("date"),
        *(f"{side}_{name}" for name in _VALUES for side in ("readings", "summaries")),
        same.alias("matches"),
    )


def stream_reconcile(readings: DataFrame, summaries: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """The user-days on which the streams differ, each once, when its day closes."""
    return stream_compare(readings, summaries, tolerance).where("NOT matches").drop("matches")
