"""Merge the small files of stored tables, reports and the id index.

    python -m pacefold.jobs.compact --tables /data/tables --retention-hours 24

It may run while streams write and reports read. What was merged is removed after the
retention time, which must be longer than any report runs.
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence

from pyspark.sql import SparkSession

from pacefold.session import build_session
from pacefold.sinks.compaction import compact, table_names
from pacefold.sinks.ids import IDS_TABLE, compact_ids
from pacefold.sinks.versions import expire
from pacefold.streaming.live import MERGES


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--tables", required=True, help="folder of Parquet tables")
    parser.add_argument(
        "--retention-hours", type=float, default=24.0, help="keep what reports may still read"
    )
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: Namespace) -> int:
    """Merge every table under the folder; returns how many batches were merged."""
    merged = 0
    for name in table_names(spark, options.tables):
        if name == IDS_TABLE:
            merged += compact_ids(spark, options.tables)
        else:
            merged += compact(spark, options.tables, name, MERGES.get(name))
        expire(spark, f"{options.tables}/{name}", options.retention_hours * 3600)
    return merged


def main() -> None:
    run(build_session("pacefold-compact"), parse())


if __name__ == "__main__":
    main()
