"""Routing mixed micro-batches: each message to its own table, plus batch reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, FEEDS, READINGS, SUMMARIES, Feed
from pacefold.functions.measures import row_count
from pacefold.operators.alerts import recent_alerts
from pacefold.operators.readings import batch_user_stats, health_snapshot
from pacefold.operators.summaries import latest_summaries
from pacefold.sinks.ids import IdIndex
from pacefold.sinks.parallel import run_all
from pacefold.sinks.tables import Sink
from pacefold.sources.tables import report_reader
from pacefold.sources.topics import quarantined
from pacefold.streaming.live import LiveTotals

Report = Callable[[DataFrame], DataFrame]

#: Table of row counts per batch and topic, unknown topics included.
ROUTING_TABLE = "topic_routing"

#: Table of messages that could not be decoded, by the ``id`` of their stored rows.
QUARANTINE_TABLE = "quarantine"


def batch_reports(latest: int = 20) -> dict[str, dict[str, Report]]:
    """Per-batch reports of each feed. They see the current batch only.

    The views of summaries and alerts show the ``latest`` ones, in a fixed order: a
    replayed batch shows the same.
    """
    return {
        READINGS.name: {
            "batch_user_stats": batch_user_stats,
            "health_snapshot": health_snapshot,
        },
        SUMMARIES.name: {"summary_view": partial(latest_summaries, k=latest)},
        ALERTS.name: {"recent_alerts": partial(recent_alerts, k=latest)},
    }


class Router:
    """``foreachBatch`` function that stores and reports on a mixed micro-batch.

    Every row goes by its own topic. Rows of unknown topics are counted in the
    routing table and not stored. Where rows are graded, the messages that could not
    be decoded are quarantined from the same decoded batch. Errors are not caught: the
    query stops, and the batch is handed out again on restart.

    With an id index, messages that were stored before are left out first, however long
    ago that was; all others are stored, however late they come. With live totals, each
    batch also stores what it adds to statistics over all batches.
    """

    def __init__(
        self,
        store: Sink,
        report: Sink | None = None,
        reports: dict[str, dict[str, Report]] | None = None,
        index: IdIndex | None = None,
        live: LiveTotals | None = None,
    ) -> None:
        self._store = store
        self._live = live
        self._index = index
        self._report = report or store
        self._reports = batch_reports() if reports is None else reports

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Used by one write per table and one per report: decode it once.
        with kept(batch) as decoded:
            if self._index is None:
                self._write(decoded, batch_id)
                return
            with kept(self._index.unseen(decoded, batch_id)) as new:
                self._write(new, batch_id)
                self._index.record(new, batch_id)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        routing = routing_counts(batch)
        feeds, any_flawed = present(routing)
        counts = routing.select("topic", "target_table", "row_count")
        writes = [(self._report, counts, ROUTING_TABLE)]
        if any_flawed:
            writes.append((self._report, quarantined(batch), QUARANTINE_TABLE))
        for feed in feeds:
            rows = feed_rows(batch, feed)
            writes.append((self._store, rows, feed.table))
            writes += [
                (self._report, report(rows), name)
                for name, report in self._reports.get(feed.name, {}).items()
            ]
            if self._live:
                added = self._live(feed.name, rows, batch_id)
                writes += [(self._report, frame, name) for name, frame in added.items()]
        run_all(
            batch.sparkSession,
            [partial(sink, rows, table, batch_id) for sink, rows, table in writes],
        )


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows that are computed once within the block."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def routing_counts(batch: DataFrame) -> DataFrame:
    """Rows per topic, those not decoded, and the table they go to; null if unknown."""
    target = F.lit(None).cast("string")
    for feed in FEEDS:
        target = F.when(F.col("topic") == feed.topic, feed.table).otherwise(target)
    flawed = F.count("grade") if "grade" in batch.columns else F.lit(0)
    return (
        batch.groupBy("topic")
        .agg(row_count("row_count"), flawed.alias("flawed_count"))
        .select("topic", target.alias("target_table"), "row_count", "flawed_count")
    )


def present(routing: DataFrame) -> tuple[list[Feed], bool]:
    """The feeds that have rows, and whether any row was not decoded.

    At most one row per feed reaches the driver.
    """
    known = routing.where(F.col("target_table").isNotNull())
    rows = known.select("topic", "flawed_count").collect()
    topics = {row.topic for row in rows}
    feeds = [feed for feed in FEEDS if feed.topic in topics]
    return feeds, any(row.flawed_count for row in rows)


def feed_rows(batch: DataFrame, feed: Feed) -> DataFrame:
    """One feed's rows of a mixed batch, with exactly its table's columns."""
    columns = [name for name in feed.stored_schema.fieldNames() if name in batch.columns]
    return batch.where(F.col("topic") == feed.topic).select(*columns)


def routing_totals(spark: SparkSession, root: str) -> DataFrame:
    """Rows per topic over all batches routed so far into Parquet tables."""
    return (
        report_reader(spark, root)(ROUTING_TABLE)
        .groupBy("topic", "target_table")
        .agg(F.sum("row_count").alias("row_count"))
    )
