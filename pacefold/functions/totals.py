"""Counts, sums and extremes that reports are made of.

The same step condenses raw rows and condenses totals of finer groups further, so one
report serves both: a table that is read for one report, and the batch job, which
condenses each table once for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Row count of a group; frames that have it hold totals. No message has such a field.
ROWS = "__rows"


def is_condensed(frame: DataFrame) -> bool:
    return ROWS in frame.columns


def totals(
    frame: DataFrame,
    keys: Sequence[str | Column],
    sums: Sequence[str] = (),
    peaks: Sequence[str] = (),
    lows: Sequence[str] = (),
) -> DataFrame:
    """Per group: rows, sum and count of some columns, maxima and minima of some."""
    condensed = is_condensed(frame)
    rows = F.coalesce(F.sum(ROWS), F.lit(0)) if condensed else F.count("*")
    measures = [rows.alias(ROWS)]
    for name in sums:
        whole, n = (F.sum(f"{name}_sum"), F.sum(f"{name}_n")) if condensed else (
            F.sum(name),
            F.count(name),
        )
        measures += [whole.alias(f"{name}_sum"), n.alias(f"{name}_n")]
    measures += [F.max(f"max_{p}" if condensed else p).alias(f"max_{p}") for p in peaks]
    measures += [F.min(f"min_{p}" if condensed else p).alias(f"min_{p}") for p in lows]
    return frame.groupBy(*keys).agg(*measures)


def mean(column: str, name: str) -> Column:
    """Mean of a column from its totals; null where it has no values."""
    return F.try_divide(F.col(f"{column}_sum"), F.col(f"{column}_n")).alias(name)
