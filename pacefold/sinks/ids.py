"""The ids of all stored messages, so that a copy is known however late it comes.

A watermark forgets: a message behind it can be told neither from a copy nor from a
message that is merely late. This index forgets nothing. It is a versioned table beside
the others, and says which ids earlier batches have stored, whatever the checkpoint.

Ids are places: a topic's partition and offset, or a file and row. Neighbouring messages
have neighbouring numbers, so the index keeps *spans* of numbers of one origin, cut at
multiples of ``BLOCK``: a batch adds some rows per partition, not one per message, and
compaction joins spans that touch. Blocks are dealt into ``BUCKETS`` folders by hash. A
batch's new messages lie in a few blocks, so it reads those blocks' folders only. Numbers
and spans are sorted together, cell by cell, so that a block of many short spans (numbers
with gaps) takes no comparison of each number with each span.

A batch is compared with what others have stored, not with itself; handed out again, it
gets the same rows. Batches of queries that run side by side do not see each other: give
a topic to one running query.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pacefold.feeds import BUCKET, FEEDS
from pacefold.operators.dedup import dedup
from pacefold.sinks import versions
from pacefold.sinks.compaction import compact, stored_columns
from pacefold.sinks.tables import write_batch, writer_name

IDS_TABLE = "known_ids"
#: Numbers of an origin that share a bucket.
BLOCK = 1 << 20
BUCKETS = 256

#: Numbers of an origin that are looked up together.
CELL = 1 << 14

#: Origins' numbers from ``low`` to ``high`` are stored.
SPANS = StructType(
    [
        StructField("origin", StringType()),
        StructField("block", LongType()),
        StructField("low", LongType()),
        StructField("high", LongType()),
        StructField(BUCKET, IntegerType()),
    ]
)
_PLACE = "^(.*):([0-9]{1,18})$"


def placed(rows: DataFrame) -> DataFrame:
    """Rows with the ``_origin``, ``_number``, ``_block`` and ``_bucket`` of their ids.

    An id that does not end in a number is an origin of its own.
    """
    number = F.regexp_extract("id", _PLACE, 2)
    numbered = number != ""
    return (
        rows.withColumns(
            {
                "_origin": F.when(numbered, F.regexp_extract("id", _PLACE, 1)).otherwise(F.col("id")),
                "_number": F.when(numbered, number.cast("long")).otherwise(F.lit(-1)),
            }
        )
        .withColumn("_block", F.floor(F.col("_number") / BLOCK).cast("long"))
        .withColumn(f"_{BUCKET}", F.pmod(F.hash("_origin", "_block"), F.lit(BUCKETS)))
    )


def spans(rows: DataFrame) -> DataFrame:
    """The spans that the rows' ids make up; copies count once."""
    single = placed(rows).select(
        F.col("_origin").alias("origin"), F.col("_block").alias("block"),
        F.col("_number").alias("low"), F.col("_number").alias("high"), F.col(f"_{BUCKET}").alias(BUCKET),
    )
    return merged_spans(single.distinct())


def merged_spans(rows: DataFrame) -> DataFrame:
    """Spans that touch or overlap as one. A group is a block, of bounded length."""
    block = Window.partitionBy(BUCKET, "origin", "block")
    earlier = block.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("low") > F.max("high").over(earlier) + 1, F.lit(True))
    island = F.sum(F.col("_begins").cast("long")).over(block.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_begins", begins)
        .withColumn("_island", island)
        .groupBy("origin", "block", "_island", BUCKET)
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .select(*SPANS.fieldNames())
    )


def _cell(number: str) -> Column:
    return F.floor(F.col(number) / CELL).cast("long")


class IdIndex:
    """The index of the tables under a folder, as one writer uses it."""

    def __init__(self, root: str, label: str | None = None) -> None:
        self._root, self._label = root, label
        self._table = f"{root}/{IDS_TABLE}"

    def unseen(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """One row per id, and none of an id that another batch has stored.

        A row without an id fails. At most ``BUCKETS`` numbers reach the driver.
        """
        spark = rows.sparkSession
        touched = [row[0] for row in placed(rows).select(f"_{BUCKET}").distinct().collect()]
        known = self.known(spark, (writer_name(spark, self._label), batch_id)).where(
            F.col(BUCKET).isin(touched)
        )
        own = [F.col(f"`{name}`") for name in rows.columns]
        asked = placed(dedup(rows)).select(
            F.col("_origin").alias("origin"), _cell("_number").alias("cell"), F.col("_number").alias("low"),
            F.lit(None).cast("long").alias("high"), F.struct(*own).alias("row"),
        )
        cells = F.explode(F.sequence(_cell("low"), _cell("high")))
        stored = known.select(
            "origin", cells.alias("cell"), "low", "high", F.lit(None).cast(asked.schema["row"].dataType).alias("row")
        )
        # Spans first: of those that begin by a number, one that reaches it holds it.
        before = Window.partitionBy("origin", "cell").orderBy("low", F.col("row").isNotNull())
        reached = F.max("high").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (
            asked.union(stored)
            .withColumn("reached", reached)
            .where(F.col("row").isNotNull() & (F.col("reached").isNull() | (F.col("reached") < F.col("low"))))
            .select("row.*")
        )

    def known(self, spark: SparkSession, but: versions.Batch | None = None) -> DataFrame:
        """Spans of all batches but one."""
        current = versions.latest(spark, self._table)
        if current is None:
            return spark.createDataFrame([], SPANS)
        others = replace(current, batches=tuple(b for b in current.batches if b != but))
        return versions.open_version(spark, self._table, others, SPANS).select(*SPANS.fieldNames())

    def record(self, rows: DataFrame, batch_id: int) -> None:
        """Add the ids of a batch whose rows are stored."""
        self._record(rows, (writer_name(rows.sparkSession, self._label), batch_id))

    def _record(self, rows: DataFrame, batch: versions.Batch) -> None:
        write_batch(spans(rows.select("id")).repartition(BUCKET), self._table, batch)

    def catch_up(self, spark: SparkSession) -> int:
        """Add the ids of stored batches that the index lacks; returns how many.

        Of tables that were written without the index, or by a query that ended between
        its last write and the index and whose checkpoint is not used any more.
        """
        current = versions.latest(spark, self._table) or versions.Version()
        missing: dict[versions.Batch, list[DataFrame]] = {}
        for feed in FEEDS:
            stored = versions.latest(spark, f"{self._root}/{feed.table}")
            if stored is None:
                continue
            rows = versions.open_version(spark, f"{self._root}/{feed.table}", stored, stored_columns(feed.table))
            for batch in {*stored.batches, *stored.through}:
                if not current.has(batch):
                    writer, number = batch
                    upto = F.col("batch_id") <= number if batch in stored.through else F.col("batch_id") == number
                    own = rows.where((F.col("writer") == writer) & upto & F.col("id").isNotNull())
                    missing.setdefault(batch, []).append(own.select("id"))
        for batch, parts in sorted(missing.items(), key=lambda item: item[0]):
            self._record(reduce(DataFrame.union, parts), batch)
        return len(missing)


def compact_ids(spark: SparkSession, root: str) -> int:
    """Merge the index's final batches, and spans that touch."""

    def merge(rows: DataFrame) -> DataFrame:
        # Whose batch a span came from does not matter any more.
        return merged_spans(rows.select(*SPANS.fieldNames())).select(
            "*", F.lit("merged").alias("writer"), F.lit(-1).cast("bigint").alias("batch_id")
        )

    return compact(spark, root, IDS_TABLE, merge, SPANS)
