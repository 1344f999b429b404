"""Totals of each micro-batch, from which statistics over all batches are merged."""

from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, READINGS, SUMMARIES
from pacefold.functions.times import with_event_time
from pacefold.operators import alerts, running, summaries
from pacefold.sinks import versions
from pacefold.sinks.compaction import Merge
from pacefold.sinks.tables import writer_name


class LiveTotals:
    """What a batch of each feed adds: frames by the name of the table they go to.

    ``delay`` is how long a day stays open for readings that come late: it closes once a
    reading is seen that is so much newer than its end. A batch is judged by what its
    writer had seen in earlier batches, so one that is handed out again is judged alike.
    """

    def __init__(self, root: str, label: str | None = None, delay: timedelta = timedelta(hours=1)) -> None:
        self._root, self._label, self._delay = root, label, delay

    def __call__(self, feed_name: str, rows: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        return {
            READINGS.name: self._readings,
            SUMMARIES.name: lambda rows, _: {running.SUMMARY_TOTALS: summaries.condense(rows)},
            ALERTS.name: lambda rows, _: {
                running.ALERT_TOTALS: alerts.condense(rows),
                running.ALERT_SKETCHES: running.alert_sketches(rows),
            },
        }[feed_name](rows, batch_id)

    def _readings(self, rows: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        spark = rows.sparkSession
        closed = self.closed_before(spark, (writer_name(spark, self._label), batch_id))
        timed = with_event_time(rows)
        out = {
            running.READING_TOTALS: running.day_totals(timed, closed),
            running.CLOCK: timed.agg(F.max("event_time").alias("newest")),
        }
        if closed is not None:
            late = running.with_lateness(timed, closed).where("late")
            out[running.LATE_READINGS] = late.select(*rows.columns)
        return out

    def closed_before(self, spark: SparkSession, batch: versions.Batch | None = None) -> datetime | None:
        """Up to when days are closed: for a batch, by the batches its writer had before.

        One number per batch that is not merged is read, one reaches the driver.
        """
        table = f"{self._root}/{running.CLOCK}"
        current = versions.latest(spark, table)
        if current is None:
            return None
        if batch:
            earlier = tuple(b for b in current.batches if b[0] == batch[0] and b[1] < batch[1])
            current = replace(current, batches=earlier)
        if not (current.batches or current.merged):
            return None
        rows = versions.open_version(spark, table, current)
        if batch:
            rows = rows.where(F.col("writer") == batch[0])
        newest = rows.agg(F.unix_micros(F.max("newest"))).first()[0]
        return None if newest is None else _time(newest) - self._delay


def _time(micros: int) -> datetime:
    return datetime.fromtimestamp(micros // 1_000_000, UTC) + timedelta(microseconds=micros % 1_000_000)


def _merged(merge: Merge, rows: DataFrame) -> DataFrame:
    """Merged totals under one batch; whose they were does not matter any more."""
    return merge(rows).withColumns({"writer": F.lit("merged"), "batch_id": F.lit(-1).cast("bigint")})


#: How the batches of these tables are merged when they are compacted.
MERGES: dict[str, Merge] = {
    running.READING_TOTALS: partial(_merged, running.merge_day_totals),
    running.SUMMARY_TOTALS: partial(_merged, summaries.condense),
    running.ALERT_TOTALS: partial(_merged, alerts.condense),
    running.ALERT_SKETCHES: partial(_merged, running.merge_alert_sketches),
    # The clock stays the writer's own.
    running.CLOCK: lambda rows: rows.groupBy("writer").agg(
        F.max("newest").alias("newest"), F.max("batch_id").alias("batch_id")
    ),
}
