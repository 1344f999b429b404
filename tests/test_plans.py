"""Plans of the batch queries: pruned scans, pushed filters, early aggregation."""

import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"

# Columns of `events` that each query needs, and no others.
COLUMNS = {
    "health_snapshot": {"event_id"},
    "chart_heart_rate_histogram": {"event_id"},
    "alert_low_activity": {"ts", "user_id"},
    "activity_sessions": {"ts", "user_id"},
    "alert_goal_achieved": {"ts", "user_id", "props"},
    "chart_steps_calories": {"value", "props"},
    "alert_type_distribution": {"event_type"},
    "user_alert_distribution": {"user_id", "event_type"},
    "alert_view": {"ts", "user_id", "event_type"},
    "user_stats": {"event_id", "user_id", "value", "props"},
    "daily_trends": {"event_id", "ts", "value", "props"},
    "hourly_user_stats": {"event_id", "ts", "user_id"},
}

AGGREGATED = sorted(
    set(COLUMNS) - {"alert_view"}
    | {
        "top_users",
        "user_performance",
        "overall_daily_stats",
        "batch_user_stats",
        "chart_alert_types",
        "chart_user_alerts",
        "chart_daily_steps_calories",
        "chart_steps_boxplot",
        "daily_summary_rollup",
        "dedup_batch",
    }
)


def plan(spark, name):
    frame = driver.queries()[name](spark, SF_DIR)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_scans_read_only_what_they_need(spark, name):
    scans = [line for line in plan(spark, name).splitlines() if "ReadSchema" in line]
    read = {
        field.split(":")[0]
        for line in scans
        for field in line.split("ReadSchema: struct<")[1].rstrip(">").split(",")
    }
    assert read == COLUMNS[name]


def test_alert_filter_reaches_the_scan(spark):
    assert "PushedFilters: [In(event_type, [error,purchase,view])]" in plan(spark, "alert_view")


@pytest.mark.parametrize("name", AGGREGATED)
def test_rows_are_combined_before_the_first_shuffle(spark, name):
    """From each scan upwards, a partial aggregate comes before any exchange."""
    below = []
    for line in reversed(plan(spark, name).splitlines()):
        if "FileScan" in line:
            below = []
        elif "Exchange" in line and "Reused" not in line:
            assert below, line
        elif "Aggregate" in line:
            below.append(line)


@pytest.mark.parametrize("name", sorted({*AGGREGATED, *COLUMNS, "quarantine", "publish_envelope"}))
def test_no_cross_joins_and_no_python_workers(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text


def test_top_users_do_not_sort_everyone(spark):
    text = plan(spark, "top_users")
    assert "TakeOrderedAndProject(limit=20" in text
    assert "rangepartitioning" not in text
