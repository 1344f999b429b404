"""Column functions between typed fields and JSON message payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_RAW = "_raw"


def payload_text(value: Column | str = "value") -> Column:
    """Message payload as text; brokers deliver bytes."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def decode(schema: StructType, value: Column | str = "value") -> Column:
    """Typed struct of a JSON payload; fields that do not fit become null."""
    return F.from_json(payload_text(value), schema)


def encode(*columns: str) -> Column:
    """JSON payload of the named columns; nulls are written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def decode_with_raw(schema: StructType, value: Column | str = "value") -> Column:
    """Like :func:`decode`, with the raw text kept when any part did not fit."""
    raw = StructType([*schema.fields, StructField(_RAW, StringType())])
    return F.from_json(payload_text(value), raw, {"columnNameOfCorruptRecord": _RAW})


def decode_grade(decoded: Column, schema: StructType) -> Column:
    """``undecodable`` (nothing usable), ``partial`` (some fields lost) or null (fine).

    ``decoded`` must come from :func:`decode_with_raw`.
    """
    any_field = reduce(
        lambda left, right: left | right,
        [decoded.getField(name).isNotNull() for name in schema.fieldNames()],
    )
    misfit = decoded.getField(_RAW).isNotNull()
    return F.when(decoded.isNull() | (misfit & ~any_field), "undecodable").when(
        misfit, "partial"
    )
