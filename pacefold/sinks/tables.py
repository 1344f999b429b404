"""Stored tables, written so that a replayed micro-batch changes nothing.

A sink is a function ``(rows, table, batch_id)``. Spark hands a micro-batch out
again after a failure, with the same id and the same rows, so each sink either
replaces the batch or skips what is already there.

Batch ids start at zero in each checkpoint, so batches are kept apart by writer, which
inside a stream is the id that the query's checkpoint gives it for good. A ``label``
is put before it; only outside a stream does the label alone tell writers apart.

Tables are also partitioned by the day their rows are about (``event_date``), so that
reports on some days read those days.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.feeds import DAY_COLUMN, FEEDS, Feed
from pacefold.functions.times import event_date
from pacefold.operators.dedup import with_key
from pacefold.sinks import versions
from pacefold.sinks.compaction import PARTITIONS
from pacefold.sinks.parallel import run_all

Sink = Callable[[DataFrame, str, int], None]


#: Where Spark keeps the id of the streaming query whose batch is being written.
_QUERY_ID = "sql.streaming.queryId"


def writer_name(spark: SparkSession, label: str | None = None) -> str:
    """The checkpoint's own id behind the label, or the label outside a stream."""
    query_id = spark.sparkContext.getLocalProperty(_QUERY_ID)
    parts = [part for part in (label, query_id) if part]
    if not parts:
        raise ValueError("outside a stream a sink needs a label that is its own")
    return "-".join(parts)


def parquet_sink(root: str, label: str | None = None) -> Sink:
    """One Parquet folder per table, a subfolder per batch, and versions that name them.

    A batch is part of the table once a version names it. A stream that hands a
    published batch out again leaves it as it is, under whoever reads it; outside a
    stream a batch replaces its own subfolder.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        spark = rows.sparkSession
        batch = (writer_name(spark, label), batch_id)
        current = versions.latest(spark, f"{root}/{table}")
        if current and current.has(batch) and spark.sparkContext.getLocalProperty(_QUERY_ID):
            return
        write_batch(with_day(rows, table), f"{root}/{table}", batch)

    return write


def write_batch(rows: DataFrame, table: str, batch: versions.Batch) -> None:
    """Write a batch's folder anew and publish it."""
    by = [name for name in PARTITIONS if name in rows.columns]
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(versions.batch_folder(table, *batch))
    )
    versions.publish(rows.sparkSession, table, lambda version: version.with_batch(batch))


def with_day(rows: DataFrame, table: str) -> DataFrame:
    """Rows of a feed's table with the day they are about; others as they are."""
    feed = next((feed for feed in FEEDS if feed.table == table), None)
    if feed is None:
        return rows
    known = feed.time_field in rows.columns
    day = event_date(F.col(feed.time_field)) if known else F.lit(None).cast("date")
    return rows.withColumn(DAY_COLUMN.name, day)


def catalog_sink(label: str | None = None, database: str | None = None) -> Sink:
    """Tables of the session's catalog; a batch replaces its own partitions."""

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        target = f"{database}.{table}" if database else table
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {target} "
            f"PARTITION (writer = :writer, batch_id = :batch_id, {DAY_COLUMN.name}) "
            "BY NAME SELECT * FROM {rows}",
            args={"writer": writer_name(rows.sparkSession, label), "batch_id": batch_id},
            rows=with_day(rows, table),
        )

    return write


def jdbc_sink(options: dict[str, str], label: str | None = None) -> Sink:
    """Database tables; rows of the batch that are already stored are skipped.

    Every row needs an ``id``; a row without one fails. Make ``id`` unique in the
    database as well, so that a repeated write by a lost task is refused instead of
    stored twice.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        writer = writer_name(rows.sparkSession, label)
        stored = (
            rows.sparkSession.read.format("jdbc")
            .options(**options)
            .option("dbtable", table)
            .load()
            .where((F.col("writer") == writer) & (F.col("batch_id") == batch_id))
        )
        (
            not_stored(_stamped(rows, writer, batch_id), stored)
            .write.format("jdbc")
            .options(**options)
            .option("dbtable", table)
            .mode("append")
            .save()
        )

    return write


def not_stored(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows whose ``id`` is not among the stored ones."""
    known = with_key(rows, ["id"])
    return known.join(stored.select("id"), "id", "left_anti").select(*rows.columns)


def create_parquet_tables(spark: SparkSession, root: str) -> None:
    """Make all three tables readable before the first batch, if they are absent."""
    run_all(
        spark,
        [
            partial(
                _empty(spark, feed).write.mode("ignore").parquet,
                f"{versions.batch_folder(f'{root}/{feed.table}', 'none', -1)}/{_NO_DAY}",
            )
            for feed in FEEDS
        ],
    )


def create_catalog_tables(
    spark: SparkSession, database: str | None = None, location: str | None = None
) -> None:
    for feed in FEEDS:
        spark.sql(create_table_statement(feed, database, location))


def create_jdbc_tables(spark: SparkSession, options: dict[str, str]) -> None:
    for feed in FEEDS:
        (
            _stamped(_empty(spark, feed), "none", -1)
            .write.format("jdbc")
            .options(**options)
            .option("dbtable", feed.table)
            .option("createTableColumnTypes", jdbc_column_types(feed))
            .mode("ignore")
            .save()
        )


def create_table_statement(
    feed: Feed, database: str | None = None, location: str | None = None
) -> str:
    name = f"{database}.{feed.table}" if database else feed.table
    fields = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in feed.stored_schema
    )
    place = f" LOCATION '{location}/{feed.table}'" if location else ""
    day = DAY_COLUMN.name
    return (
        f"CREATE TABLE IF NOT EXISTS {name} "
        f"({fields}, writer string, batch_id bigint, {day} date) "
        f"USING parquet PARTITIONED BY (writer, batch_id, {day}){place}"
    )


# Column widths of the existing database tables.
_TEXT_WIDTHS = {
    "user_id": "VARCHAR(20)",
    "alert_type": "VARCHAR(50)",
    "timestamp": "VARCHAR(30)",
    "date": "VARCHAR(30)",
}


def jdbc_column_types(feed: Feed) -> str:
    """Column widths for a database table, in the form Spark's JDBC writer takes."""
    widths = {"id": "VARCHAR(100)", "writer": "VARCHAR(100)", **_TEXT_WIDTHS}
    names = [*feed.stored_schema.fieldNames(), "writer"]
    return ", ".join(f"`{name}` {widths[name]}" for name in names if name in widths)


#: Partition of rows whose day cannot be read.
_NO_DAY = f"{DAY_COLUMN.name}=__HIVE_DEFAULT_PARTITION__"


def _stamped(rows: DataFrame, writer: str, batch_id: int) -> DataFrame:
    return rows.withColumn("writer", F.lit(writer)).withColumn(
        "batch_id", F.lit(batch_id).cast("bigint")
    )


def _empty(spark: SparkSession, feed: Feed) -> DataFrame:
    # The limit turns it into a constant, written by one task.
    return spark.createDataFrame([], feed.stored_schema).limit(0)
