"""Comparison of streaming results with batch results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def closed_days(daily: DataFrame, watermark: datetime) -> DataFrame:
    """The days whose end the watermark of a stream has passed.

    A stopped query gives its own (:func:`pacefold.streaming.run.last_watermark`), so
    the readings are not read again for it.
    """
    day_end = F.date_add(F.to_date("date"), 1).cast("timestamp")
    return daily.where(day_end <= F.lit(watermark))


def compare(
    batch: DataFrame,
    stream: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    tolerance: float = 1e-9,
) -> DataFrame:
    """Full outer join on the keys, with both sides' values and a ``matches`` flag.

    Both inputs must hold one row per key, as aggregates do. Null keys match null
    keys. Doubles match within a relative tolerance, because engines add them up
    in different orders; everything else must be equal or null on both sides.
    """
    sides = {"batch": batch, "stream": stream}
    left, right = (
        frame.select(
            *(F.col(key).alias(f"{side}_key_{key}") for key in keys),
            *(F.col(value).alias(f"{side}_{value}") for value in values),
            F.lit(True).alias(f"in_{side}"),
        )
        for side, frame in sides.items()
    )
    same_key = _all(
        [F.col(f"batch_key_{k}").eqNullSafe(F.col(f"stream_key_{k}")) for k in keys]
    )
    same_values = _all(
        [
            same_value(
                F.col(f"batch_{value}"),
                F.col(f"stream_{value}"),
                isinstance(batch.schema[value].dataType, DoubleType),
                tolerance,
            )
            for value in values
        ]
    )
    in_both = F.col("in_batch").isNotNull() & F.col("in_stream").isNotNull()
    return left.join(right, same_key, "full_outer").select(
        *(
            F.coalesce(f"batch_key_{key}", f"stream_key_{key}").alias(key)
            for key in keys
        ),
        *(f"{side}_{value}" for value in values for side in sides),
        F.col("in_batch").isNotNull().alias("in_batch"),
        F.col("in_stream").isNotNull().alias("in_stream"),
        (in_both & same_values).alias("matches"),
    )


def reconcile(
    batch: DataFrame,
    stream: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    tolerance: float = 1e-9,
) -> DataFrame:
    """Only the rows on which batch and stream differ."""
    compared = compare(batch, stream, keys, values, tolerance)
    return compared.where(~F.col("matches")).drop("in_batch", "in_stream", "matches")


def reconcile_report(
    batch: DataFrame,
    stream: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    by: str,
    tolerance: float = 1e-9,
) -> DataFrame:
    """Per value of one key: rows on each side, matching and differing rows."""
    return (
        compare(batch, stream, keys, values, tolerance)
        .groupBy(by)
        .agg(
            F.count_if("in_batch").alias("batch_rows"),
            F.count_if("in_stream").alias("stream_rows"),
            F.count_if("matches").alias("matching_rows"),
            F.count_if(~F.col("matches")).alias("differing_rows"),
        )
        .orderBy(by)
    )


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def same_value(left: Column, right: Column, is_double: bool, tolerance: float) -> Column:
    """Whether two values agree: doubles within a relative tolerance, null with null."""
    same = left.eqNullSafe(right)
    if not is_double:
        return same
    scale = F.greatest(F.lit(1.0), F.abs(left), F.abs(right))
    close = F.abs(left - right) <= scale * tolerance
    return same | F.coalesce(close, F.lit(False))
