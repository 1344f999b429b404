"""Comparison of batch and streaming results."""

from datetime import datetime, timedelta

import pytest

from pacefold.operators import reconcile

SCHEMA = "user_id string, date string, steps bigint, calories double"
KEYS, VALUES = ["user_id", "date"], ["steps", "calories"]


def frames(spark, batch, stream):
    return spark.createDataFrame(batch, SCHEMA), spark.createDataFrame(stream, SCHEMA)


def test_equal_sides_give_no_rows(spark):
    rows = [("a", "d", 1, 0.1 + 0.2), (None, "d", None, None), (None, None, 3, 1e12)]
    other = [("a", "d", 1, 0.3), (None, "d", None, None), (None, None, 3, 1e12 + 1e-4)]
    assert reconcile.reconcile(*frames(spark, rows, other), KEYS, VALUES).collect() == []


def test_every_kind_of_difference_is_listed(spark):
    batch = [("a", "d", 1, 1.0), ("b", "d", 1, 1.0), ("c", "d", 1, None), ("e", "d", 1, 1.0)]
    stream = [("a", "d", 2, 1.0), ("b", "d", 1, 1.001), ("c", "d", 1, 1.0), ("f", "d", 1, 1.0)]
    both = frames(spark, batch, stream)
    differing = reconcile.reconcile(*both, KEYS, VALUES)
    assert differing.columns == [
        "user_id",
        "date",
        "batch_steps",
        "stream_steps",
        "batch_calories",
        "stream_calories",
    ]
    assert sorted(map(tuple, differing.collect())) == [
        ("a", "d", 1, 2, 1.0, 1.0),
        ("b", "d", 1, 1, 1.0, 1.001),
        ("c", "d", 1, 1, None, 1.0),
        ("e", "d", 1, None, 1.0, None),
        ("f", "d", None, 1, None, 1.0),
    ]
    report = reconcile.reconcile_report(*both, KEYS, VALUES, by="date").collect()
    assert [tuple(row) for row in report] == [("d", 4, 4, 0, 5)]


def test_a_row_of_nulls_on_one_side_only_differs(spark):
    both = frames(spark, [("a", "d", None, None)], [])
    assert reconcile.reconcile(*both, KEYS, VALUES).count() == 1


@pytest.mark.parametrize(
    ("last", "days"), [("2024-01-02 00:59:59", []), ("2024-01-02 01:00:00", ["2024-01-01"])]
)
def test_a_day_is_closed_once_the_watermark_reaches_its_end(spark, last, days):
    daily = spark.createDataFrame(
        [("a", "2024-01-01", 1, 1.0), ("a", "2024-01-02", 1, 1.0), ("a", None, 1, 1.0)], SCHEMA
    )
    watermark = datetime.fromisoformat(f"{last}+00:00") - timedelta(hours=1)
    closed = reconcile.closed_days(daily, watermark)
    assert [row.date for row in closed.collect()] == days
