"""Publish rows of a stored table as messages of its feed.

    python -m pacefold.jobs.publish --feed readings --rows /data/rows \
        --bootstrap-servers broker:9092
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence

from pyspark.sql import SparkSession

from pacefold.feeds import FEEDS
from pacefold.jobs.options import add_options
from pacefold.session import build_session
from pacefold.sinks.topics import publish_to_files, publish_to_kafka


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--feed", required=True, choices=[feed.name for feed in FEEDS])
    parser.add_argument("--rows", required=True, help="Parquet folder of rows")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--bootstrap-servers", help="Kafka brokers")
    target.add_argument("--messages", help="folder of message files, one per topic")
    parser.add_argument("--format", default="parquet", help="format of message files")
    add_options(parser, "kafka", "further Kafka options")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: Namespace) -> None:
    feed = next(feed for feed in FEEDS if feed.name == options.feed)
    rows = spark.read.parquet(options.rows)
    if options.bootstrap_servers:
        publish_to_kafka(rows, feed, options.bootstrap_servers, **dict(options.kafka))
    else:
        publish_to_files(rows, feed, options.messages, options.format)


def main() -> None:
    options = parse()
    run(build_session("pacefold-publish"), options)


if __name__ == "__main__":
    main()
