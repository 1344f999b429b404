"""The order of sorted reports, which comparisons of sorted rows do not see."""

import pytest

from pacefold.operators.tables import preview
from pacefold.plans.queries import registry

SF_DIR = "/root/testdata/sf0.001"

#: Columns that each report is ordered by, "-" for descending.
ORDERS = {
    "user_stats": ("-avg_steps", "user_id"),
    "top_users": ("-avg_steps", "user_id"),
    "daily_trends": ("date",),
    "user_performance": ("-avg_daily_steps", "user_id"),
    "alert_type_distribution": ("-count", "alert_type"),
    "user_alert_distribution": ("-total_alerts", "user_id"),
    "recent_alerts": ("-timestamp", "user_id", "alert_type"),
    "chart_alert_types": ("-count", "key"),
    "chart_user_alerts": ("-count", "key"),
    "chart_heart_rate_histogram": ("bin",),
    "reconcile_report": ("date",),
    "batch_job_user_stats": ("-avg_steps", "user_id"),
    "batch_job_alert_type_distribution": ("-count", "alert_type"),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    rows = [row.asDict() for row in registry()[name](spark, SF_DIR).collect()]
    expected = rows
    for key in reversed(ORDERS[name]):
        column = key.removeprefix("-")
        expected = sorted(expected, key=lambda r: r[column], reverse=key.startswith("-"))
    assert len(rows) > 1 and rows == expected


def test_a_preview_is_some_rows(spark):
    frame = spark.range(100)
    assert preview(frame).count() == 5
    assert preview(frame, 200).count() == 100
    assert {row.id for row in preview(frame, 7).collect()} <= set(range(100))
