"""The query registry: every operator over the fixture tables.

Each entry takes a session and a folder with an ``events`` table. Means and sums
of doubles are rounded, since engines add them up in different orders. Entries
that exercise streams publish the messages as files under the shared folder, run
the stream over all of them, and return what it stored.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, TimestampType

from pacefold.feeds import ALERTS, FEEDS, READINGS, SUMMARIES, Feed
from pacefold.functions.messages import LOW_ACTIVITY
from pacefold.functions.times import timestamp_text, with_event_time
from pacefold.jobs.live import reports as live_reports
from pacefold.operators import (
    alerting,
    alerts,
    charts,
    dedup,
    readings,
    reconcile,
    rollups,
    summaries,
    tables,
)
from pacefold.plans import batch, fixtures
from pacefold.session import new_scratch, require_settings, workers_find_package
from pacefold.sinks import files, versions
from pacefold.sinks.compaction import compact
from pacefold.sinks.ids import IdIndex, compact_ids
from pacefold.sinks.tables import create_parquet_tables, parquet_sink
from pacefold.sinks.topics import encode_messages, publish_to_files
from pacefold.sources.tables import parquet_reader, report_reader
from pacefold.sources.topics import (
    TopicSource,
    combined_stream,
    decode_messages,
    deduplicated,
    file_source,
    message_id,
    quarantine,
    read_topic,
    union_feeds,
)
from pacefold.streaming.goals import stream_goals
from pacefold.streaming.live import MERGES, LiveTotals
from pacefold.streaming.reconcile import stream_reconcile, with_summary_time
from pacefold.streaming.router import Router, routing_totals
from pacefold.streaming.run import (
    AVAILABLE_NOW,
    last_watermark,
    run_and_watermark,
    run_to_table,
    start_batches,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Decimals kept of doubles. With fewer, means of two-decimal values over 32 or 64
#: rows end exactly half way between two results, and noise decides the rounding.
DIGITS = 9
STEP_GOAL = 500
#: Summaries are told with two decimals.
TOLD_TOLERANCE = 1e-6
WATERMARK_DELAY = "1 hour"
#: When silent users are looked for, after the last reading of the fixtures.
AS_OF = datetime(2024, 2, 15, tzinfo=UTC)
#: How long versions of a table that was written to are kept.
RETENTION_SECONDS = 3600.0
#: Readings with a higher heart rate than this do not reach the incomplete stream.
STREAMED_RATE = 145


def registry() -> dict[str, Query]:
    return {name: _comparable(query) for name, query in _QUERIES.items()}


def _comparable(query: Query) -> Query:
    """Pin the zone, round doubles and spell out times, as the oracle does."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        require_settings(spark)
        workers_find_package(spark)
        result = query(spark, sf_dir)
        return result.select(*(_comparable_column(f) for f in result.schema.fields))

    return run


def _comparable_column(field: StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, DoubleType):
        return F.round(column, DIGITS).alias(field.name)
    if isinstance(field.dataType, TimestampType):
        return timestamp_text(column).alias(field.name)
    return column


def _on(feed: Feed, report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_feed(spark, sf_dir, feed))


def _feed(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    return fixtures.table(spark, sf_dir, feed).select(*feed.schema.fieldNames())


def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {feed.name: _feed(spark, sf_dir, feed) for feed in FEEDS}


# -- messages and streams ---------------------------------------------------


def _published(
    spark: SparkSession, sf_dir: str, label: str, feeds: tuple[Feed, ...] = FEEDS
) -> str:
    root = new_scratch(spark, label)
    fixtures.publish(spark, sf_dir, f"{root}/messages", feeds)
    return root


def _decode(feed: Feed) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _published(spark, sf_dir, f"decode-{feed.name}", (feed,))
        stream = read_topic(spark, feed, file_source(f"{root}/messages"))
        return run_to_table(stream, root).drop("id")

    return run


def _publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = [encode_messages(_feed(spark, sf_dir, feed), feed) for feed in FEEDS]
    return union_feeds(encoded)


def _combined_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _published(spark, sf_dir, "combined")
    stream = combined_stream(spark, file_source(f"{root}/messages"))
    return run_to_table(stream, root).drop("id")


def _routed(spark: SparkSession, sf_dir: str, label: str) -> str:
    root = _published(spark, sf_dir, label)
    create_parquet_tables(spark, f"{root}/tables")
    _route(spark, file_source(f"{root}/messages"), root)
    return f"{root}/tables"


def _route(
    spark: SparkSession,
    source: TopicSource,
    root: str,
    checkpoint: str = "checkpoint",
    index: IdIndex | None = None,
    live: bool = False,
) -> None:
    """Store everything a source has now, with the sink's own settings."""
    start_batches(
        combined_stream(spark, source, graded=True),
        Router(
            parquet_sink(f"{root}/tables"),
            index=index,
            live=LiveTotals(f"{root}/tables") if live else None,
        ),
        f"{root}/{checkpoint}",
        AVAILABLE_NOW,
    ).awaitTermination()


def _readings_of(spark: SparkSession, root: str) -> DataFrame:
    return parquet_reader(spark, f"{root}/tables")(READINGS).select(*READINGS.schema.fieldNames())


def _stored_without_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without broker positions, copies dropped by id: none may be lost."""
    root = new_scratch(spark, "no-positions")
    fixtures.publish(spark, sf_dir, f"{root}/messages", positions=False)
    create_parquet_tables(spark, f"{root}/tables")
    _route(spark, deduplicated(file_source(f"{root}/messages")), root)
    return _readings_of(spark, root)


def _stored_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries, each with a checkpoint of its own, store into the same tables."""
    root = new_scratch(spark, "two-checkpoints")
    create_parquet_tables(spark, f"{root}/tables")
    high = F.col("heart_rate") > STREAMED_RATE
    for name, part in (("low", ~high), ("high", high)):
        rows = fixtures.readings(spark, sf_dir).where(part)
        publish_to_files(rows, READINGS, f"{root}/{name}")
        for feed in (SUMMARIES, ALERTS):
            publish_to_files(fixtures.table(spark, sf_dir, feed).limit(0), feed, f"{root}/{name}")
        _route(spark, file_source(f"{root}/{name}"), root, f"checkpoint-{name}")
    return _readings_of(spark, root)


def _compacted_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings stored in one batch per message file, merged afterwards."""
    root = _published(spark, sf_dir, "compacted")
    fixtures.publish(spark, sf_dir, f"{root}/messages", (READINGS,))
    create_parquet_tables(spark, f"{root}/tables")
    _route(spark, file_source(f"{root}/messages", spread=True, maxFilesPerTrigger="1"), root)
    compact(spark, f"{root}/tables", READINGS.table)
    return _copies(_readings_of(spark, root))


def _copies(rows: DataFrame) -> DataFrame:
    """How often each row is there."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def _read_during_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a report that began before batches were merged, replaced and expired."""
    root = _published(spark, sf_dir, "read-compacted")
    fixtures.publish(spark, sf_dir, f"{root}/messages", (READINGS,))
    source = file_source(f"{root}/messages", spread=True, maxFilesPerTrigger="1")
    _route(spark, source, root)
    opened = _readings_of(spark, root)
    compact(spark, f"{root}/tables", READINGS.table)
    fixtures.publish(spark, sf_dir, f"{root}/messages", (READINGS,))
    _route(spark, source, root)
    compact(spark, f"{root}/tables", READINGS.table)
    versions.expire(spark, f"{root}/tables/{READINGS.table}", RETENTION_SECONDS)
    return _copies(opened)


def _read_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as they were before more were stored and all were merged."""
    root, table = new_scratch(spark, "as-of"), READINGS.table
    high = F.col("heart_rate") > STREAMED_RATE
    for part in (~high, high):
        publish_to_files(fixtures.readings(spark, sf_dir).where(part), READINGS, f"{root}/messages")
        for feed in (SUMMARIES, ALERTS):
            publish_to_files(fixtures.table(spark, sf_dir, feed).limit(0), feed, f"{root}/messages")
        _route(spark, file_source(f"{root}/messages", spread=True, maxFilesPerTrigger="1"), root)
        if part is not high:
            earlier = versions.latest(spark, f"{root}/tables/{table}").number
            compact(spark, f"{root}/tables", table)
    compact(spark, f"{root}/tables", table)
    read = parquet_reader(spark, f"{root}/tables", version=earlier)
    return read(READINGS).select(*READINGS.schema.fieldNames())


def _topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing_totals(spark, _routed(spark, sf_dir, "routing"))


def _stored(feed: Feed) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _routed(spark, sf_dir, f"stored-{feed.name}")
        stored = parquet_reader(spark, root)(feed)
        return stored.select(*feed.stored_schema.fieldNames())

    return run


def _stored_report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _routed(spark, sf_dir, name.replace("_", "-"))
        return report_reader(spark, root)(name).drop("writer", "batch_id")

    return run


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(fixtures.flawed_messages(spark, sf_dir, READINGS), READINGS)


def _decode_flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(fixtures.flawed_messages(spark, sf_dir, READINGS), READINGS)


def _dedup_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages are published twice, before and again after the first run."""
    root = new_scratch(spark, "dedup")
    source = deduplicated(file_source(f"{root}/messages"))
    for _ in range(2):
        fixtures.publish(spark, sf_dir, f"{root}/messages", (READINGS,))
        stored = run_to_table(read_topic(spark, READINGS, source), root)
    return stored.select(*READINGS.schema.fieldNames())


def _dedup_flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for messages that cannot be decoded and have no readable time."""
    root = new_scratch(spark, "dedup-flawed")
    source = deduplicated(file_source(f"{root}/messages"))
    messages = fixtures.flawed_messages(spark, sf_dir, READINGS)
    for _ in range(2):
        messages.write.mode("append").parquet(f"{root}/messages/{READINGS.topic}")
        stored = run_to_table(read_topic(spark, READINGS, source), root)
    return stored


def _late_files(spark: SparkSession, root: str, name: str, rows: DataFrame, hours: int) -> None:
    """Message files under ``name`` whose time of change lies ``hours`` back."""
    publish_to_files(rows, READINGS, f"{root}/{name}")
    folder = f"{root}/{name}/{READINGS.topic}"
    now = int(datetime.now(UTC).timestamp() * 1000)
    for file in files.file_names(spark, folder):
        files.set_changed_at(spark, f"{folder}/{file}", now - hours * 3_600_000)


def _dedup_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come in later but are dated earlier, with copies: all readings, once.

    The first run stores some readings; the next one finds the others, and all of the
    first again, in files that are two days old.
    """
    root = new_scratch(spark, "dedup-late")
    rows, high = fixtures.readings(spark, sf_dir), F.col("heart_rate") > STREAMED_RATE
    index = IdIndex(f"{root}/tables")
    source = deduplicated(file_source(f"{root}/messages"), "1 minute")
    for hours, part in ((0, high), (48, F.lit(True))):
        _late_files(spark, root, "messages", rows.where(part), hours)
        for feed in (SUMMARIES, ALERTS):
            publish_to_files(fixtures.table(spark, sf_dir, feed).limit(0), feed, f"{root}/messages")
        _route(spark, source, root, index=index)
    return _copies(_readings_of(spark, root))


def _dedup_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that lost its checkpoint reads all messages from the start, with new ones."""
    root = new_scratch(spark, "dedup-checkpoint")
    index = IdIndex(f"{root}/tables")
    low = fixtures.readings(spark, sf_dir).where(F.col("heart_rate") <= STREAMED_RATE)
    publish_to_files(low, READINGS, f"{root}/messages")
    for feed in (SUMMARIES, ALERTS):
        publish_to_files(fixtures.table(spark, sf_dir, feed).limit(0), feed, f"{root}/messages")
    source = file_source(f"{root}/messages", spread=True, maxFilesPerTrigger="1")
    _route(spark, source, root, "first", index)
    compact(spark, f"{root}/tables", READINGS.table)
    compact_ids(spark, f"{root}/tables")
    fixtures.publish(spark, sf_dir, f"{root}/messages", (READINGS,))
    _route(spark, source, root, "second", index)
    return _copies(_readings_of(spark, root))


def _dedup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.readings(spark, sf_dir)
    messages = encode_messages(rows.union(rows), READINGS)
    once = dedup.dedup(messages.withColumn("id", message_id(messages)))
    return decode_messages(once, READINGS).drop("topic")


def _live(spark: SparkSession, sf_dir: str, label: str) -> dict[str, DataFrame]:
    """Reports from the totals of two runs, compacted in between.

    The second run brings the readings with a high rate, most of them of closed days.
    """
    root = new_scratch(spark, label)
    rows, high = fixtures.readings(spark, sf_dir), F.col("heart_rate") > STREAMED_RATE
    fixtures.publish(spark, sf_dir, f"{root}/messages", (SUMMARIES, ALERTS))
    for part in (~high, high):
        publish_to_files(rows.where(part), READINGS, f"{root}/messages")
        _route(spark, file_source(f"{root}/messages"), root, live=True)
        for name in MERGES:
            compact(spark, f"{root}/tables", name, MERGES[name])
    return live_reports(spark, f"{root}/tables", timedelta(hours=1))


def _live_report(name: str) -> Query:
    return lambda spark, sf_dir: _live(spark, sf_dir, name.replace("_", "-"))[name]


def _running_alert_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different users per alert type, and whether their sketch is off by 5 % at most."""
    rows = _live(spark, sf_dir, "running-alert-users")["alert_users"]
    off = F.abs(F.col("estimated_users") - F.col("users"))
    return rows.select("alert_type", "alerts", "users", (off <= F.col("users") * 0.05).alias("sketch_is_near"))


def _timed_readings(spark: SparkSession, root: str) -> DataFrame:
    stream = read_topic(spark, READINGS, file_source(f"{root}/messages"))
    return with_event_time(stream, WATERMARK_DELAY)


def _streamed(label: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A windowed operator over the readings stream: the windows it has closed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _published(spark, sf_dir, label, (READINGS,))
        return run_to_table(operator(_timed_readings(spark, root)), root)

    return run


def _low_activity_alerts(readings_stream: DataFrame) -> DataFrame:
    events = alerting.stream_low_activity(alerting.stream_sessions(readings_stream))
    return alerting.as_alerts(
        events.select("user_id", timestamp_text(F.col("time")).alias("timestamp")),
        LOW_ACTIVITY,
    )


def _stream_goals(readings_stream: DataFrame) -> DataFrame:
    return stream_goals(readings_stream, STEP_GOAL).withColumnRenamed("time", "timestamp")


def _reconciled(spark: SparkSession, sf_dir: str) -> dict:
    """Arguments of the comparison: both roll-ups of the days the stream closed."""
    return _against_batch(spark, sf_dir, _published(spark, sf_dir, "reconcile", (READINGS,)))


def _differing(spark: SparkSession, sf_dir: str) -> dict:
    """The same with a stream that some readings did not reach."""
    root = new_scratch(spark, "reconcile-differing")
    rows = fixtures.readings(spark, sf_dir).where(F.col("heart_rate") <= STREAMED_RATE)
    publish_to_files(rows, READINGS, f"{root}/messages")
    return _against_batch(spark, sf_dir, root)


def _stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries told of all readings against a stream that some did not reach."""
    root = new_scratch(spark, "stream-reconcile")
    rows = fixtures.readings(spark, sf_dir).where(F.col("heart_rate") <= STREAMED_RATE)
    publish_to_files(rows, READINGS, f"{root}/messages")
    fixtures.publish(spark, sf_dir, f"{root}/messages", (SUMMARIES,))
    told = read_topic(spark, SUMMARIES, file_source(f"{root}/messages"))
    return run_to_table(
        stream_reconcile(
            _timed_readings(spark, root), with_summary_time(told, WATERMARK_DELAY), TOLD_TOLERANCE
        ),
        root,
    )


def _against_batch(spark: SparkSession, sf_dir: str, root: str) -> dict:
    windows = rollups.daily_summary_windows(_timed_readings(spark, root))
    streamed, query = run_and_watermark(windows, root)
    daily = rollups.daily_summary_rollup(_feed(spark, sf_dir, READINGS))
    return {
        "batch": reconcile.closed_days(daily, last_watermark(query)),
        "stream": streamed,
        "keys": ["user_id", "date"],
        "values": ["total_steps", "total_calories", "avg_heart_rate"],
    }


# -- charts and derived alerts ----------------------------------------------


def _outliers(rows: DataFrame) -> DataFrame:
    return charts.boxplot_outliers(rows, "total_steps").select(
        "user_id", "date", "total_steps"
    )


def _low_activity(rows: DataFrame) -> DataFrame:
    return alerting.low_activity_gaps(rows).select(
        "user_id",
        F.col("time").alias("timestamp"),
        F.col("next_time").alias("next_timestamp"),
    )


def _goals(rows: DataFrame) -> DataFrame:
    return alerting.goals_achieved(rows, STEP_GOAL).withColumnRenamed(
        "time", "timestamp"
    )


def _derived_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts derived from readings, published to the alert feed and read from it."""
    root = new_scratch(spark, "derived")
    rows = alerting.derived_alerts(_feed(spark, sf_dir, READINGS), goal=STEP_GOAL, as_of=AS_OF)
    publish_to_files(rows, ALERTS, f"{root}/messages")
    stream = read_topic(spark, ALERTS, file_source(f"{root}/messages"))
    return run_to_table(stream, root).select(*ALERTS.schema.fieldNames())


def _condensed(
    feed: Feed,
    condense: Callable[[DataFrame], DataFrame],
    report: Callable[[DataFrame], DataFrame],
) -> Query:
    """One report of the batch job, from the table it condenses first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        condensed = condense(_feed(spark, sf_dir, feed))
        return report(batch.written(condensed, new_scratch(spark, f"condensed-{feed.name}")))

    return run


_QUERIES: dict[str, Query] = {
    # stored-table reports
    "user_stats": _on(READINGS, readings.user_stats),
    "top_users": _on(READINGS, readings.top_users),
    "daily_trends": _on(READINGS, readings.daily_trends),
    "user_performance": _on(SUMMARIES, summaries.user_performance),
    "overall_daily_stats": _on(SUMMARIES, summaries.overall_daily_stats),
    "alert_type_distribution": _on(ALERTS, alerts.alert_type_distribution),
    "user_alert_distribution": _on(ALERTS, alerts.user_alert_distribution),
    "table_row_counts": lambda spark, sf_dir: tables.table_row_counts(
        _feeds(spark, sf_dir)
    ),
    # micro-batch reports
    "batch_user_stats": _on(READINGS, readings.batch_user_stats),
    "health_snapshot": _on(READINGS, readings.health_snapshot),
    "daily_summary_view": _on(SUMMARIES, summaries.daily_summary_view),
    "alert_view": _on(ALERTS, alerts.alert_view),
    "recent_alerts": _on(ALERTS, alerts.recent_alerts),
    # messages, streams, storage
    "decode_readings": _decode(READINGS),
    "decode_summaries": _decode(SUMMARIES),
    "decode_alerts": _decode(ALERTS),
    "decode_flawed": _decode_flawed,
    "publish_envelope": _publish_envelope,
    "combined_stream": _combined_stream,
    "topic_routing": _topic_routing,
    "stored_readings": _stored(READINGS),
    "stored_summaries": _stored(SUMMARIES),
    "stored_alerts": _stored(ALERTS),
    "stream_batch_user_stats": _stored_report("batch_user_stats"),
    "stream_health_snapshot": _stored_report("health_snapshot"),
    "stream_summary_view": _stored_report("summary_view"),
    "stream_recent_alerts": _stored_report("recent_alerts"),
    "stored_without_positions": _stored_without_positions,
    "stored_two_checkpoints": _stored_two_checkpoints,
    "compacted_readings": _compacted_readings,
    "read_during_compaction": _read_during_compaction,
    "read_as_of_version": _read_as_of_version,
    "dedup_flawed": _dedup_flawed,
    "quarantine": _quarantine,
    "dedup_readings": _dedup_readings,
    # statistics over all batches, from what each added
    "running_user_stats": _live_report("user_stats"),
    "running_daily_trends": _live_report("daily_trends"),
    "running_health_snapshot": _live_report("health_snapshot"),
    "running_user_performance": _live_report("user_performance"),
    "running_user_alerts": _live_report("user_alert_distribution"),
    "running_alert_users": _running_alert_users,
    "late_told_daily": _live_report("days"),
    "late_corrections": _live_report("day_corrections"),
    "late_corrected_daily": _live_report("corrected_days"),
    "dedup_late_files": _dedup_late_files,
    "dedup_new_checkpoint": _dedup_new_checkpoint,
    "dedup_batch": _dedup_batch,
    # chart data
    "chart_heart_rate_histogram": _on(
        READINGS, lambda rows: charts.histogram(rows, "heart_rate")
    ),
    "chart_steps_calories": _on(
        READINGS, lambda rows: charts.point_counts(rows, "steps", "calories")
    ),
    "chart_steps_boxplot": _on(
        SUMMARIES, lambda rows: charts.boxplot(rows, "total_steps")
    ),
    "chart_steps_outliers": _on(SUMMARIES, _outliers),
    "chart_daily_steps_calories": _on(
        SUMMARIES, lambda rows: charts.point_counts(rows, "total_steps", "total_calories")
    ),
    "chart_alert_types": _on(ALERTS, lambda rows: charts.value_counts(rows, "alert_type")),
    "chart_user_alerts": _on(ALERTS, lambda rows: charts.value_counts(rows, "user_id")),
    # derived from readings
    "daily_summary_rollup": _on(READINGS, rollups.daily_summary_rollup),
    "hourly_user_stats": _on(READINGS, rollups.periodic_user_stats),
    "alert_high_heart_rate": _on(READINGS, alerting.high_heart_rate_alerts),
    "alert_low_activity": _on(READINGS, _low_activity),
    "activity_sessions": _on(READINGS, alerting.activity_sessions),
    "alert_goal_achieved": _on(READINGS, _goals),
    "alert_goal_messages": _on(READINGS, lambda rows: alerting.goal_alerts(rows, STEP_GOAL)),
    "alert_low_activity_messages": _on(
        READINGS, lambda rows: alerting.low_activity_alerts(rows, as_of=AS_OF)
    ),
    "derived_alert_feed": _derived_feed,
    # the same on streams
    "stream_daily_summary": _streamed("daily", rollups.daily_summary_windows),
    "stream_hourly_user_stats": _streamed("hourly", rollups.periodic_user_stats),
    "stream_activity_sessions": _streamed("sessions", alerting.stream_sessions),
    "stream_low_activity": _streamed("low-activity", _low_activity_alerts),
    "stream_goal_achieved": _streamed("goals", _stream_goals),
    "stream_high_heart_rate": _streamed("high-rate", alerting.high_heart_rate_alerts),
    "reconcile_daily": lambda spark, sf_dir: reconcile.reconcile(
        **_reconciled(spark, sf_dir)
    ),
    "reconcile_report": lambda spark, sf_dir: reconcile.reconcile_report(
        **_reconciled(spark, sf_dir), by="date"
    ),
    "reconcile_differing": lambda spark, sf_dir: reconcile.reconcile(
        **_differing(spark, sf_dir)
    ),
    "stream_reconcile": _stream_reconcile,
    # the batch job's reports, from tables condensed once
    "batch_job_user_stats": _condensed(READINGS, readings.condense, readings.user_stats),
    "batch_job_daily_trends": _condensed(READINGS, readings.condense, readings.daily_trends),
    "batch_job_user_performance": _condensed(
        SUMMARIES, summaries.condense, summaries.user_performance
    ),
    "batch_job_overall_daily_stats": _condensed(
        SUMMARIES, summaries.condense, summaries.overall_daily_stats
    ),
    "batch_job_alert_type_distribution": _condensed(
        ALERTS, alerts.condense, alerts.alert_type_distribution
    ),
    "batch_job_user_alert_distribution": _condensed(
        ALERTS, alerts.condense, alerts.user_alert_distribution
    ),
    "batch_job_table_row_counts": lambda spark, sf_dir: tables.table_row_counts(
        batch.condense_tables(_feeds(spark, sf_dir), new_scratch(spark, "condensed"))
    ),
}
