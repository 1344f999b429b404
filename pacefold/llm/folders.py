"""Intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.session import new_scratch, remove_folder

Store = Callable[[DataFrame, str], DataFrame]

#: Lower-cases A-Z alone, as the vectorised readers do.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    return _written(frame, new_scratch(frame.sparkSession, label))


@contextmanager
def workspace(spark: SparkSession, label: str) -> Iterator[Store]:
    """A ``store`` for tables that are only needed inside the block; removed at its end."""
    root, count = new_scratch(spark, label), 0

    def store(frame: DataFrame, name: str) -> DataFrame:
        nonlocal count
        count += 1
        return _written(frame, f"{root}/{count}-{name}")

    try:
        yield store
    finally:
        remove_folder(spark, root)


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Slots of the sieve that rows pass before a join on their ids, 8 bytes each.
SIEVE_SLOTS = 1 << 21


def of_ids(frame: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of a wide frame whose id is in ``ids``, which may be of any size.

    The ids' hashed slots, at most ``SIEVE_SLOTS`` numbers, are sent to all executors
    and hold back most other rows before the join shuffles what is left by its id.
    """

    def slot(name: str):
        return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(SIEVE_SLOTS)).alias("_slot")

    sieve = F.broadcast(ids.select(slot(column)).distinct())
    passed = frame.withColumn("_slot", slot(column)).join(sieve, "_slot", "left_semi")
    return passed.drop("_slot").join(ids.select(column), column, "left_semi")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_of_id(modulus: int, column: str = "doc_id"):
    """``crc32`` of the id's decimal text, modulo ``modulus``; null ids count as empty."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text):
    """Lower-case A-Z; a plain ``lower`` does it where there is nothing but ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
