"""Row counts and previews of any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.functions.totals import ROWS, totals


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows, from rows or from totals."""
    counts = [
        totals(table, []).select(
            F.lit(name).alias("table_name"), F.col(ROWS).alias("row_count")
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(frame: DataFrame, rows: int = 5) -> DataFrame:
    """Any first rows of a frame, for a look at it."""
    return frame.limit(rows)
