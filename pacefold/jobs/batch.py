"""Compute all reports over the stored tables.

    python -m pacefold.jobs.batch --tables /data/tables --output /data/reports
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pacefold.feeds import FEEDS
from pacefold.jobs.options import add_options
from pacefold.plans.batch import run_batch, written
from pacefold.session import build_session, new_scratch, remove_folder
from pacefold.sinks.parallel import run_all
from pacefold.sources.tables import jdbc_reader, load_tables, parquet_reader


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--tables", help="folder of Parquet tables")
    add_options(parser, "jdbc", "read a database instead; url, driver, user, ...")
    parser.add_argument(
        "--split-by", default="batch_id", help="numeric column of database tables"
    )
    parser.add_argument("--splits", type=int, default=32, help="parallel database reads")
    parser.add_argument("--output", required=True, help="folder of reports")
    parser.add_argument(
        "--scratch", help="folder for this run alone; default: in spark.checkpoint.dir"
    )
    parser.add_argument("--as-of", type=utc, help="report users silent at this time (UTC)")
    options = parser.parse_args(arguments)
    if bool(options.tables) == bool(options.jdbc):
        parser.error("give either --tables or --jdbc")
    return options


def utc(text: str) -> datetime:
    time = datetime.fromisoformat(text)
    return time if time.tzinfo else time.replace(tzinfo=UTC)


def run(spark: SparkSession, options: Namespace) -> dict[str, str]:
    scratch = options.scratch or new_scratch(spark, "batch-job")
    try:
        if options.jdbc:
            reader = jdbc_reader(spark, dict(options.jdbc), options.split_by, options.splits)
            tables = copied(load_tables(reader), f"{scratch}/copies")
        else:
            tables = load_tables(parquet_reader(spark, options.tables))
        return run_batch(tables, options.output, f"{scratch}/reports", options.as_of)
    finally:
        remove_folder(spark, scratch)


def copied(tables: dict[str, DataFrame], scratch: str) -> dict[str, DataFrame]:
    """Copies of the feeds' fields, so that a database is read once and not per report."""
    fields = {feed.name: feed.schema.fieldNames() for feed in FEEDS}
    steps = [
        partial(written, table.select(*fields[name]), f"{scratch}/{name}")
        for name, table in tables.items()
    ]
    spark = next(iter(tables.values())).sparkSession
    return dict(zip(tables, run_all(spark, steps), strict=True))


def main() -> None:
    options = parse()
    run(build_session("pacefold-batch"), options)


if __name__ == "__main__":
    main()
