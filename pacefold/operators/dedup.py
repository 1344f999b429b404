"""Idempotent ingest: one copy of each message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MESSAGE_KEY = ("id",)


def with_key(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """The frame, which fails on a row without its key instead of losing it.

    Rows without a key would all pass for copies of one another.
    """
    error = F.raise_error(F.lit(f"a row has no {', '.join(key)}: it cannot be told from others"))
    return frame.withColumns({name: F.coalesce(F.col(name), error) for name in key})


def dedup(frame: DataFrame, key: Sequence[str] = MESSAGE_KEY) -> DataFrame:
    """One row per key (batch); copies are combined in the map tasks first."""
    return with_key(frame, key).dropDuplicates(list(key))


def dedup_stream(
    stream: DataFrame, key: Sequence[str] = MESSAGE_KEY, salt: int = 16
) -> DataFrame:
    """One row per key (stream with a watermark), also across micro-batches.

    Rows behind the watermark are left out, so it belongs on a time that never goes back:
    that of the micro-batch, not one that a message or its broker tells. A streaming dedup sends all copies of a key to one task, and a message may have very
    many copies. They are therefore first thinned out in ``salt`` sub-groups side by
    side, so that at most ``salt`` copies per key go on. Where copies are known to be
    few, ``salt=0`` saves that step and its state. Choose before the first start: a
    checkpoint belongs to one choice.
    """
    stream = with_key(stream, key)
    if salt > 1:
        stream = (
            stream.withColumn("_salt", F.floor(F.rand(seed=17) * salt))
            .dropDuplicatesWithinWatermark([*key, "_salt"])
            .drop("_salt")
        )
    return stream.dropDuplicatesWithinWatermark(list(key))
