"""The batch job: every report over the three stored tables.

Reading the tables is what costs at scale, so the job condenses each one once
(per user and day, per user, per user and alert type), writes the condensed rows
to its own folder under the shared one, and computes all tabular reports from those.
Charts and what is derived from single readings need other groupings and read the few
columns of the tables that they need. The folder is removed at the end.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pacefold.operators import alerting, alerts, charts, readings, rollups, summaries
from pacefold.operators.tables import table_row_counts
from pacefold.session import new_scratch, remove_folder
from pacefold.sinks.parallel import run_all

CONDENSED = {
    "readings": readings.condense,
    "summaries": summaries.condense,
    "alerts": alerts.condense,
}


def run_batch(
    tables: dict[str, DataFrame],
    output: str,
    scratch: str | None = None,
    as_of: datetime | None = None,
) -> dict[str, str]:
    """Compute all reports and write each to its own Parquet folder.

    ``scratch`` is a new folder that all executors can reach, by default one in the
    session's shared folder. ``as_of`` also reports users who have fallen silent.
    """
    spark = _session(tables)
    scratch = scratch or new_scratch(spark, "batch-job")
    try:
        reports = batch_reports(tables, scratch, as_of)
        paths = {name: f"{output}/{name}" for name in reports}
        run_all(
            spark,
            [
                partial(report.write.mode("overwrite").parquet, paths[name])
                for name, report in reports.items()
            ],
        )
    finally:
        remove_folder(spark, scratch)
    return paths


def batch_reports(
    tables: dict[str, DataFrame], scratch: str, as_of: datetime | None = None
) -> dict[str, DataFrame]:
    """All reports by name; condenses the tables into the scratch folder on the way."""
    steps = charts.distinct_values(tables["summaries"], "total_steps")
    condensed, step_counts = run_all(
        _session(tables),
        [
            partial(condense_tables, tables, scratch),
            partial(written, steps, f"{scratch}/steps"),
        ],
    )
    step_box = written(charts.boxplot_of(step_counts), f"{scratch}/steps-box")
    return (
        tabular_reports(condensed)
        | chart_reports(tables, step_box)
        | derived_reports(tables["readings"], as_of)
    )


def condense_tables(tables: dict[str, DataFrame], scratch: str) -> dict[str, DataFrame]:
    """Each table condensed, written and read back."""
    steps = [
        partial(written, condense(tables[name]), f"{scratch}/condensed-{name}")
        for name, condense in CONDENSED.items()
    ]
    return dict(zip(CONDENSED, run_all(_session(tables), steps), strict=True))


def tabular_reports(condensed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    activity, performance, counts = (condensed[name] for name in CONDENSED)
    return {
        "table_row_counts": table_row_counts(condensed),
        "user_stats": readings.user_stats(activity),
        "daily_trends": readings.daily_trends(activity),
        "user_performance": summaries.user_performance(performance),
        "overall_daily_stats": summaries.overall_daily_stats(performance),
        "alert_type_distribution": alerts.alert_type_distribution(counts),
        "user_alert_distribution": alerts.user_alert_distribution(counts),
        "chart_alert_types": charts.value_counts(counts, "alert_type"),
        "chart_user_alerts": charts.value_counts(counts, "user_id"),
    }


def chart_reports(tables: dict[str, DataFrame], step_box: DataFrame) -> dict[str, DataFrame]:
    rows, days = tables["readings"], tables["summaries"]
    outliers = charts.beyond_fences(days, "total_steps", step_box)
    return {
        "chart_heart_rate_histogram": charts.histogram(rows, "heart_rate"),
        "chart_steps_calories": charts.point_counts(rows, "steps", "calories"),
        "chart_steps_boxplot": step_box,
        "chart_steps_outliers": outliers.select("user_id", "date", "total_steps"),
        "chart_daily_steps_calories": charts.point_counts(days, "total_steps", "total_calories"),
    }


def derived_reports(rows: DataFrame, as_of: datetime | None = None) -> dict[str, DataFrame]:
    """What single readings give rise to."""
    return {
        "daily_summary_rollup": rollups.daily_summary_rollup(rows),
        "hourly_user_stats": rollups.periodic_user_stats(rows),
        "activity_sessions": alerting.activity_sessions(rows),
        "low_activity_gaps": alerting.low_activity_gaps(rows, as_of=as_of),
        "goals_achieved": alerting.goals_achieved(rows),
        "derived_alerts": alerting.derived_alerts(rows, as_of=as_of),
    }


def written(frame: DataFrame, path: str) -> DataFrame:
    """The frame's rows, written to a folder and read back."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _session(frames: dict[str, DataFrame]) -> SparkSession:
    return next(iter(frames.values())).sparkSession
