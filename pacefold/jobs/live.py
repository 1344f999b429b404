"""Report on everything a stream has stored, from the totals it keeps with ``--live``.

    python -m pacefold.jobs.live --tables /data/tables --output /data/live

Reads totals, not readings: it may run every few minutes, beside the stream. Days are
told once they are closed; what came later corrects them by signed rows.
"""

from __future__ import annotations

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pacefold.jobs.options import hours
from pacefold.operators import alerts, running, summaries
from pacefold.session import build_session
from pacefold.sinks import versions
from pacefold.sinks.parallel import run_all
from pacefold.sources.tables import report_reader
from pacefold.streaming.live import LiveTotals


def parse(arguments: Sequence[str] | None = None) -> Namespace:
    parser = ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--tables", required=True, help="folder of the stream's tables")
    parser.add_argument("--output", required=True, help="folder of reports")
    parser.add_argument("--delay", type=hours, default=timedelta(hours=1), help="hours a day stays open; as the stream's --live")
    return parser.parse_args(arguments)


def reports(spark: SparkSession, root: str, delay: timedelta) -> dict[str, DataFrame]:
    """The reports that the stored totals allow; a feed without totals has none."""
    read = report_reader(spark, root)
    out = {}
    if (days := stored(spark, root, running.READING_TOTALS)) is not None:
        out["user_stats"] = running.user_stats(days)
        out["daily_trends"] = running.daily_trends(days)
        out["health_snapshot"] = running.health_snapshot(days)
        closed = LiveTotals(root, delay=delay).closed_before(spark)
        if closed:
            told, signed = running.told_days(days, closed), running.corrections(days, closed)
            out |= {"days": told, "day_corrections": signed, "corrected_days": running.corrected_days(told, signed)}
    if (per_user := stored(spark, root, running.SUMMARY_TOTALS)) is not None:
        out["user_performance"] = summaries.user_performance(per_user)
        out["overall_daily_stats"] = summaries.overall_daily_stats(per_user)
    if (per_type := stored(spark, root, running.ALERT_TOTALS)) is not None:
        out["alert_type_distribution"] = alerts.alert_type_distribution(per_type)
        out["user_alert_distribution"] = alerts.user_alert_distribution(per_type)
        out["alert_users"] = running.alert_users(per_type, read(running.ALERT_SKETCHES))
    return out


def stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return report_reader(spark, root)(name) if versions.latest(spark, f"{root}/{name}") else None


def run(spark: SparkSession, options: Namespace) -> list[str]:
    """Write every report; returns their names."""
    made = reports(spark, options.tables, options.delay)
    steps = [
        partial(frame.write.mode("overwrite").parquet, f"{options.output}/{name}")
        for name, frame in made.items()
    ]
    run_all(spark, steps)
    return sorted(made)


def main() -> None:
    options = parse()
    run(build_session("pacefold-live"), options)


if __name__ == "__main__":
    main()
