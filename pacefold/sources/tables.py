"""Stored tables: Parquet folders, catalog tables and databases over JDBC.

A table that cannot be read raises; no caller goes on with a missing input.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pacefold.feeds import BATCH_COLUMNS, FEEDS, Feed
from pacefold.sinks import versions
from pacefold.sinks.compaction import stored_columns

TableReader = Callable[[Feed], DataFrame]


def parquet_reader(
    spark: SparkSession, root: str, version: int | None = None, as_of: datetime | None = None
) -> TableReader:
    """Tables written by :func:`pacefold.sinks.tables.parquet_sink`.

    A filter on ``event_date`` reads the folders of those days only. A table is read at
    its newest version, at the one with a number, or as it was at a time; what is written
    or merged afterwards does not change the rows. A table without versions is read as
    its folder lies.
    """

    def read(feed: Feed) -> DataFrame:
        table, columns = f"{root}/{feed.table}", stored_columns(feed.table)
        found = _version(spark, table, version, as_of)
        if found:
            return versions.open_version(spark, table, found, columns)
        return spark.read.schema(StructType([*columns.fields, *BATCH_COLUMNS])).parquet(table)

    return read


def report_reader(
    spark: SparkSession, root: str, version: int | None = None, as_of: datetime | None = None
) -> Callable[[str], DataFrame]:
    """Reports of a stream by name, read like its tables."""

    def read(name: str) -> DataFrame:
        found = _version(spark, f"{root}/{name}", version, as_of)
        if found:
            return versions.open_version(spark, f"{root}/{name}", found)
        return spark.read.parquet(f"{root}/{name}")

    return read


def _version(
    spark: SparkSession, table: str, number: int | None, when: datetime | None
) -> versions.Version | None:
    if number is not None:
        return versions.version(spark, table, number)
    return versions.as_of(spark, table, when) if when else versions.latest(spark, table)


def catalog_reader(spark: SparkSession, database: str | None = None) -> TableReader:
    def read(feed: Feed) -> DataFrame:
        return spark.table(f"{database}.{feed.table}" if database else feed.table)

    return read


def jdbc_reader(
    spark: SparkSession,
    options: dict[str, str],
    partition_column: str | None = "batch_id",
    num_partitions: int = 32,
) -> TableReader:
    """Tables of a database, read in parallel ranges of a numeric column.

    ``options`` carry url, driver and credentials. Tables this package wrote have a
    numeric ``batch_id`` and a text ``id``; where the database numbers its rows, split
    by that number. Without a partition column the whole table arrives through one
    connection.
    """

    def read(feed: Feed) -> DataFrame:
        split = {}
        if partition_column:
            bounds = (
                spark.read.format("jdbc")
                .options(**options)
                .option("query", bounds_query(feed.table, partition_column))
                .load()
                .first()
            )
            split = split_options(partition_column, num_partitions, bounds[0], bounds[1])
        return (
            spark.read.format("jdbc")
            .options(**options, **split)
            .option("dbtable", feed.table)
            .load()
        )

    return read


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"


def split_options(
    column: str, num_partitions: int, low: int | None, high: int | None
) -> dict[str, str]:
    """Options that make Spark read ranges of a column; none for an empty table."""
    if low is None:
        return {}
    if isinstance(low, str):
        raise ValueError(
            f"column {column} holds text and cannot be cut into ranges; "
            "split by a number, such as batch_id"
        )
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(num_partitions),
    }


def load_tables(read: TableReader) -> dict[str, DataFrame]:
    """All three tables by feed name."""
    return {feed.name: read(feed) for feed in FEEDS}
