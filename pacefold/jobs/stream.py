"""Store and report on messages as they arrive.

    python -m pacefold.jobs.stream --bootstrap-servers broker:9092 \
        --tables /data/tables --checkpoint /data/checkpoints/main
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from pacefold.feeds import FEEDS
from pacefold.jobs.options import add_options, hours
from pacefold.session import build_session
from pacefold.sinks.ids import IdIndex
from pacefold.sinks.tables import (
    create_jdbc_tables,
    create_parquet_tables,
    jdbc_sink,
    parquet_sink,
)
from pacefold.sources.topics import (
    TopicSource,
    combined_stream,
    deduplicated,
    file_source,
    kafka_source,
)
from pacefold.streaming.live import LiveTotals
from pacefold.streaming.router import Router, batch_reports
from pacefold.streaming.run import AVAILABLE_NOW, start_batches


#: Messages per batch and topic of a Kafka query, unless another bound is given.
MOST_OFFSETS = 10_000_000


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers", help="Kafka brokers")
    source.add_argument("--messages", help="folder of message files, one per topic")
    parser.add_argument("--format", default="parquet", help="format of message files")
    parser.add_argument(
        "--feeds",
        nargs="+",
        choices=[feed.name for feed in FEEDS],
        default=[feed.name for feed in FEEDS],
        help="feeds of this query; run busy feeds as queries of their own",
    )
    parser.add_argument("--tables", required=True, help="folder of tables and reports")
    parser.add_argument("--checkpoint", required=True, help="folder of the checkpoint")
    parser.add_argument("--label", help="name to put before the checkpoint's own id")
    parser.add_argument("--latest", type=int, default=20, help="rows of the latest-rows views")
    parser.add_argument(
        "--dedup", metavar="DELAY", help='drop copies that come within, say, "1 hour"'
    )
    parser.add_argument(
        "--known-ids",
        action="store_true",
        help="drop copies of whatever is stored, also after a new checkpoint's first start",
    )
    parser.add_argument(
        "--live", metavar="DELAY", type=hours, help="keep totals over all batches; days close after so many hours"
    )
    bound = parser.add_mutually_exclusive_group()
    bound.add_argument(
        "--max-offsets", type=int, help="messages per batch and topic (10,000,000)"
    )
    bound.add_argument("--max-files", type=int, help="message files per batch and topic")
    pace = parser.add_mutually_exclusive_group()
    pace.add_argument("--once", action="store_true", help="stop when caught up")
    pace.add_argument("--every", default="1 minute", help="interval between batches")
    add_options(parser, "jdbc", "store the tables in a database; url, driver, user, ...")
    add_options(parser, "kafka", "further Kafka options")
    options = parser.parse_args(arguments)
    if options.messages and options.max_offsets:
        parser.error("--max-offsets bounds Kafka batches; give --max-files with --messages")
    if options.bootstrap_servers and options.max_files:
        parser.error("--max-files bounds batches of files; give --max-offsets for Kafka")
    return options


def topic_source(options: Namespace) -> TopicSource:
    if options.bootstrap_servers:
        source = kafka_source(
            options.bootstrap_servers, options.max_offsets or MOST_OFFSETS, **dict(options.kafka)
        )
    else:
        bound = {"maxFilesPerTrigger": str(options.max_files)} if options.max_files else {}
        # Messages that are not told from copies first would be decoded by one task a file.
        spread = bool(bound) and not options.dedup
        source = file_source(options.messages, options.format, spread, **bound)
    return deduplicated(source, options.dedup) if options.dedup else source


def start(spark: SparkSession, options: Namespace) -> StreamingQuery:
    """One query: it stores, reports and quarantines from one reading of the topics."""
    feeds = tuple(feed for feed in FEEDS if feed.name in options.feeds)
    return start_batches(
        combined_stream(spark, topic_source(options), feeds, graded=True),
        _router(spark, options),
        options.checkpoint,
        AVAILABLE_NOW if options.once else {"processingTime": options.every},
        options.label,
    )


def _router(spark: SparkSession, options: Namespace) -> Router:
    files, reports = parquet_sink(options.tables, options.label), batch_reports(options.latest)
    index = IdIndex(options.tables, options.label) if options.known_ids else None
    live = LiveTotals(options.tables, options.label, options.live) if options.live else None
    if options.jdbc:
        database = dict(options.jdbc)
        create_jdbc_tables(spark, database)
        return Router(jdbc_sink(database, options.label), files, reports, index, live)
    create_parquet_tables(spark, options.tables)
    if index:
        index.catch_up(spark)
    return Router(files, files, reports, index, live)


def main() -> None:
    options = parse()
    start(build_session("pacefold-stream"), options).awaitTermination()


if __name__ == "__main__":
    main()
