"""Merging the small files that micro-batches leave in Parquet tables.

A batch is handed out again only until the next one begins, so all batches of a writer
but its newest are final and may be merged. The merged rows keep their writer and batch;
they are written beside the batches, and a new version of the table puts them in their
place. Reports that have opened an earlier version go on reading the batches, which
:func:`pacefold.sinks.versions.expire` removes later. A run that was interrupted has
published nothing; what it left goes with the expired folders.

Merged folders are merged again only while they are small: once there are ``FOLDERS`` of
them, so a row is rewritten a few times at most in a table's life.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pacefold.feeds import BUCKET, DAY_COLUMN, FEEDS
from pacefold.sinks import files, versions
from pacefold.sinks.versions import Version

#: Merged folders a table may have before they are merged with each other.
FOLDERS = 16

Merge = Callable[[DataFrame], DataFrame]


def table_names(spark: SparkSession, root: str) -> list[str]:
    """Tables and reports under a folder: all that has batches of some writer."""
    return [
        name for name in files.subfolders(spark, root) if files.subfolders(spark, f"{root}/{name}", "writer=")
    ]


def compact(
    spark: SparkSession,
    root: str,
    name: str,
    merge: Merge | None = None,
    columns: StructType | None = None,
) -> int:
    """Merge the final batches of a table or report; returns how many were merged.

    ``merge`` may condense the rows on the way; ``columns`` are those of a table that is
    no feed's.
    """
    table = f"{root}/{name}"
    # A table that was written before it had versions gets its first one.
    current = versions.publish(spark, table, lambda version: version)
    newest: dict[str, int] = {}
    for writer, number in current.batches:
        newest[writer] = max(number, newest.get(writer, number))
    final = {batch for batch in current.batches if batch[1] < newest[batch[0]]}
    older = set(current.merged) if len(current.merged) >= FOLDERS else set()
    if len(final) < 2 and not older:
        return 0
    chosen = Version(batches=tuple(sorted(final)), merged=tuple(sorted(older)))
    rows = versions.open_version(spark, table, chosen, columns or stored_columns(name))
    folder = uuid.uuid4().hex
    _write(merge(rows) if merge else rows, versions.merged_folder(table, folder))
    versions.publish(spark, table, lambda version: version.with_merged(folder, final, older))
    return len(final)


def stored_columns(name: str) -> StructType | None:
    """Columns of a feed's stored table but for writer and batch; none for reports."""
    feed = next((feed for feed in FEEDS if feed.table == name), None)
    return StructType([*feed.stored_schema.fields, DAY_COLUMN]) if feed else None


#: Columns that split a table's folders, if it has them.
PARTITIONS = (DAY_COLUMN.name, BUCKET)


def _write(rows: DataFrame, target: str) -> None:
    by = [name for name in PARTITIONS if name in rows.columns]
    # Files of a good size: small days are written by one task, large ones by many.
    rows.hint("rebalance", *by).write.partitionBy(*by).parquet(target)
