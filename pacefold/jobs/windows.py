"""Days, hours, sessions, alerts and comparisons, from the topics as messages arrive.

    python -m pacefold.jobs.windows --bootstrap-servers broker:9092 \
        --what days sessions reconcile --output /data/windows --checkpoint /data/checkpoints/windows

Each is a query of its own, with its own checkpoint, and appends to a Parquet table of its
name once the watermark has closed what a row is about: each row exactly once.
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pacefold.feeds import READINGS, SUMMARIES
from pacefold.functions.messages import GOAL_ACHIEVED, LOW_ACTIVITY
from pacefold.functions.times import timestamp_text, with_event_time
from pacefold.jobs.options import add_options
from pacefold.operators import alerting, rollups
from pacefold.session import build_session
from pacefold.sources.topics import TopicSource, file_source, kafka_source, read_topic
from pacefold.streaming.goals import stream_goals
from pacefold.streaming.reconcile import stream_reconcile, with_summary_time
from pacefold.streaming.run import AVAILABLE_NOW, start_table

Operator = Callable[[DataFrame, Namespace], DataFrame]


def _low_activity(readings: DataFrame, options: Namespace) -> DataFrame:
    sessions = alerting.stream_sessions(readings, options.gap)
    paused = alerting.stream_low_activity(sessions, options.gap)
    return alerting.as_alerts(_at(paused), LOW_ACTIVITY)


def _goals(readings: DataFrame, options: Namespace) -> DataFrame:
    return alerting.as_alerts(_at(stream_goals(readings, options.goal)), GOAL_ACHIEVED)


def _at(events: DataFrame) -> DataFrame:
    return events.select("user_id", timestamp_text(F.col("time")).alias("timestamp"))


#: What each query makes of the readings; ``reconcile`` reads the summaries as well.
OPERATORS: dict[str, Operator] = {
    "days": lambda readings, options: rollups.daily_summary_windows(readings),
    "hours": lambda readings, options: rollups.periodic_user_stats(readings),
    "sessions": lambda readings, options: alerting.stream_sessions(readings, options.gap),
    "low_activity": _low_activity,
    "high_heart_rate": lambda readings, options: alerting.high_heart_rate_alerts(readings, options.limit),
    "goals": _goals,
}
RECONCILE = "reconcile"


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers", help="Kafka brokers")
    source.add_argument("--messages", help="folder of message files, one per topic")
    parser.add_argument("--format", default="parquet", help="format of message files")
    names = [*OPERATORS, RECONCILE]
    parser.add_argument("--what", nargs="+", choices=names, default=names, help="queries to run")
    parser.add_argument("--output", required=True, help="folder of tables")
    parser.add_argument("--checkpoint", required=True, help="folder of checkpoints")
    parser.add_argument("--delay", default="1 hour", help="how late messages may come")
    parser.add_argument("--limit", type=int, default=100, help="highest normal heart rate")
    parser.add_argument("--gap", type=int, default=3600, help="seconds without a reading")
    parser.add_argument("--goal", type=int, default=10000, help="steps a day")
    parser.add_argument(
        "--tolerance", type=float, default=1e-6, help="relative difference of equal sums"
    )
    pace = parser.add_mutually_exclusive_group()
    pace.add_argument("--once", action="store_true", help="stop when caught up")
    pace.add_argument("--every", default="1 minute", help="interval between batches")
    add_options(parser, "source", "further options of the source")
    return parser.parse_args(arguments)


def stream(spark: SparkSession, source: TopicSource, name: str, options: Namespace) -> DataFrame:
    readings = with_event_time(read_topic(spark, READINGS, source), options.delay)
    if name != RECONCILE:
        return OPERATORS[name](readings, options)
    told = with_summary_time(read_topic(spark, SUMMARIES, source), options.delay)
    return stream_reconcile(readings, told, options.tolerance)


def start(spark: SparkSession, options: Namespace) -> list[StreamingQuery]:
    more = dict(options.source)
    if options.bootstrap_servers:
        source = kafka_source(options.bootstrap_servers, **more)
    else:
        source = file_source(options.messages, options.format, **more)
    trigger = AVAILABLE_NOW if options.once else {"processingTime": options.every}
    return [
        start_table(
            stream(spark, source, name, options),
            f"{options.output}/{name}",
            f"{options.checkpoint}/{name}",
            trigger,
        )
        for name in options.what
    ]


def main() -> None:
    spark = build_session("pacefold-windows")
    started = start(spark, parse())
    try:
        spark.streams.awaitAnyTermination()  # raises if a query has failed
        for query in started:
            query.awaitTermination()
    finally:
        for query in started:
            query.stop()


if __name__ == "__main__":
    main()
