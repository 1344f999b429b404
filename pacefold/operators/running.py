"""Statistics over all micro-batches, from what each batch added to them.

Every batch stores small totals of its own rows: counts, sums, extremes and a sketch, all
of which can be merged. A statistic over everything that was ever stored merges totals,
and no reading is read again; a batch that is handed out again replaces or keeps its
totals, so nothing is added twice.

The totals of readings are per user and day and also say whether the day was already
closed when the batch came (``late``). What was on time makes up the days as the stream
first told them; what was late corrects them, by a row with sign -1 that takes back what
was told and one with sign +1 in its place.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.feeds import SUMMARIES
from pacefold.functions.times import date_text, ensure_event_time
from pacefold.functions.totals import ROWS, mean, totals
from pacefold.operators import alerts, readings

READING_TOTALS = "reading_totals"
SUMMARY_TOTALS = "summary_totals"
ALERT_TOTALS = "alert_totals"
ALERT_SKETCHES = "alert_sketches"
CLOCK = "stream_clock"
LATE_READINGS = "late_readings"

_KEYS = ("user_id", "day", "late")
_SUMS = ("steps", "calories", "heart_rate")
_PEAKS = ("steps", "calories", "heart_rate")
_LOWS = ("heart_rate",)


def day_totals(timed: DataFrame, closed: datetime | None) -> DataFrame:
    """Totals of a batch per user, day and whether the day was closed by then."""
    return totals(with_lateness(timed, closed), _KEYS, _SUMS, _PEAKS, _LOWS)


def with_lateness(rows: DataFrame, closed: datetime | None) -> DataFrame:
    """Readings with their ``day`` and whether it ended by ``closed``.

    Readings without a readable time have no day and are never late.
    """
    timed = ensure_event_time(rows).withColumn("day", F.to_date("event_time"))
    return timed.withColumn("late", F.coalesce(_ended_by(closed), F.lit(False)))


def _ended_by(watermark: datetime | None) -> Column:
    if watermark is None:
        return F.lit(False)
    return F.date_add("day", 1).cast("timestamp") <= F.lit(watermark)


def merge_day_totals(day_rows: DataFrame) -> DataFrame:
    return totals(day_rows, _KEYS, _SUMS, _PEAKS, _LOWS)


# -- over everything ---------------------------------------------------------


def user_stats(day_rows: DataFrame) -> DataFrame:
    return readings.user_stats(day_rows)


def daily_trends(day_rows: DataFrame) -> DataFrame:
    return readings.daily_trends(day_rows)


def health_snapshot(day_rows: DataFrame) -> DataFrame:
    return totals(day_rows, (), _SUMS, _PEAKS, _LOWS).select(
        mean("heart_rate", "avg_heart_rate"), "max_heart_rate", "min_heart_rate"
    )


def alert_sketches(rows: DataFrame) -> DataFrame:
    """Per alert type: alerts, and a sketch of the users they went to."""
    users = F.hll_sketch_agg(F.coalesce("user_id", F.lit("")), F.lit(SKETCH_BITS))
    return rows.groupBy("alert_type").agg(F.count(F.lit(1)).alias(ROWS), users.alias("users"))


#: A sketch of 2^14 registers is off by less than 1 % of the users, as a rule.
SKETCH_BITS = 14


def merge_alert_sketches(rows: DataFrame) -> DataFrame:
    return rows.groupBy("alert_type").agg(
        F.sum(ROWS).alias(ROWS), F.hll_union_agg("users").alias("users")
    )


def alert_users(alert_rows: DataFrame, sketch_rows: DataFrame) -> DataFrame:
    """Per alert type: alerts, different users, and the sketch's estimate of these.

    The exact number needs the totals per user and type, the estimate a few kilobytes.
    """
    exact = (
        alerts.condense(alert_rows)
        .groupBy("alert_type")
        .agg(F.sum(ROWS).alias("alerts"), F.count(F.lit(1)).alias("users"))
    )
    sketched = merge_alert_sketches(sketch_rows).select(
        F.col("alert_type").alias("_type"), F.hll_sketch_estimate("users").alias("estimated_users")
    )
    same = F.col("alert_type").eqNullSafe(F.col("_type"))
    return exact.join(sketched, same, "left").drop("_type")


# -- days and their corrections ----------------------------------------------


def told_days(day_rows: DataFrame, closed: datetime) -> DataFrame:
    """The days that are closed, as they were first told: without what came late."""
    return _summaries(day_rows.where(~F.col("late") & _ended_by(closed)))


def corrections(day_rows: DataFrame, closed: datetime) -> DataFrame:
    """Signed rows that make told days right; ``late_readings`` says how many were late.

    A user-day of late readings alone was not told, and is not taken back.
    """
    ended = day_rows.where(_ended_by(closed))
    merged = merge_day_totals(ended).groupBy("user_id", "day").agg(
        F.coalesce(F.sum(F.when(F.col("late"), F.col(ROWS))), F.lit(0)).alias("late_readings")
    )
    corrected = merged.where("late_readings > 0").select(
        F.col("user_id").alias("_user"), F.col("day").alias("_day"), "late_readings"
    )
    same = F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("day") == F.col("_day"))
    signed = [
        _summaries(rows.join(corrected, same, "left_semi"), "day").withColumn("sign", F.lit(sign))
        for sign, rows in ((-1, ended.where(~F.col("late"))), (1, ended))
    ]
    return (
        signed[0].unionByName(signed[1]).join(corrected, same)
        .select(*SUMMARIES.schema.fieldNames(), "sign", "late_readings")
    )


def corrected_days(told: DataFrame, corrected: DataFrame) -> DataFrame:
    """Told days with their corrections applied."""
    key = corrected.select(F.col("user_id").alias("_user"), F.col("date").alias("_date")).distinct()
    same = F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("date") == F.col("_date"))
    right = corrected.where("sign > 0").select(*told.columns)
    return told.join(key, same, "left_anti").unionByName(right)


def _summaries(day_rows: DataFrame, *more: str) -> DataFrame:
    """Daily summaries from totals, as the roll-up of the readings has them."""
    per_day = totals(day_rows, ("user_id", "day"), _SUMS)
    rate = F.round(F.try_divide("heart_rate_sum", "heart_rate_n")).cast("int")
    return per_day.select(
        "user_id",
        F.col("steps_sum").alias("total_steps"),
        F.col("calories_sum").alias("total_calories"),
        rate.alias("avg_heart_rate"),
        date_text(F.col("day")).alias("date"),
        *more,
    )
