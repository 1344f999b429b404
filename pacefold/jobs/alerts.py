"""Derive alerts from stored readings and publish them to the alert feed.

    python -m pacefold.jobs.alerts --tables /data/tables --days 2024-01-01 2024-01-02 \
        --bootstrap-servers broker:9092

Reads the partitions of the given days only. Pauses across the days' edges are seen
where both sides are among them; give each run the day before as well if that matters.
A run publishes all alerts of its days: run it once per day that is complete.
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, DAY_COLUMN, READINGS
from pacefold.jobs.batch import utc
from pacefold.jobs.options import add_options
from pacefold.operators.alerting import derived_alerts
from pacefold.session import build_session
from pacefold.sinks.topics import publish_to_files, publish_to_kafka
from pacefold.sources.tables import parquet_reader


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--tables", required=True, help="folder of Parquet tables")
    parser.add_argument("--days", nargs="+", help="days to read (yyyy-mm-dd); default: all")
    parser.add_argument("--limit", type=int, default=100, help="highest normal heart rate")
    parser.add_argument("--gap", type=int, default=3600, help="seconds without a reading")
    parser.add_argument("--goal", type=int, default=10000, help="steps a day")
    parser.add_argument("--as-of", type=utc, help="alert on users silent at this time (UTC)")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--bootstrap-servers", help="Kafka brokers")
    target.add_argument("--messages", help="folder of message files, one per topic")
    parser.add_argument("--format", default="parquet", help="format of message files")
    add_options(parser, "kafka", "further Kafka options")
    return parser.parse_args(arguments)


def alerts(spark: SparkSession, options: Namespace) -> DataFrame:
    rows = parquet_reader(spark, options.tables)(READINGS)
    if options.days:
        rows = rows.where(F.col(DAY_COLUMN.name).isin([F.lit(d).cast("date") for d in options.days]))
    return derived_alerts(rows, options.limit, options.gap, options.goal, options.as_of)


def run(spark: SparkSession, options: Namespace) -> None:
    found = alerts(spark, options)
    if options.bootstrap_servers:
        publish_to_kafka(found, ALERTS, options.bootstrap_servers, **dict(options.kafka))
    else:
        publish_to_files(found, ALERTS, options.messages, options.format)


def main() -> None:
    options = parse()
    run(build_session("pacefold-alerts"), options)


if __name__ == "__main__":
    main()
