"""Aggregates by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def measures(function: Callable[[str], Column], **outputs: str) -> list[Column]:
    """One aggregate function over several columns: output name = input column."""
    return [function(column).alias(name) for name, column in outputs.items()]


def row_count(name: str) -> Column:
    return F.count("*").alias(name)
