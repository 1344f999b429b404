"""Totals over all batches against reports on all rows; late readings and corrections."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, FEEDS, READINGS, SUMMARIES
from pacefold.jobs import compact, live, stream
from pacefold.operators import alerts, readings, rollups, running, summaries
from pacefold.sinks.tables import parquet_sink
from pacefold.sinks.topics import publish_to_files
from pacefold.sources.tables import load_tables, parquet_reader, report_reader
from pacefold.streaming.live import LiveTotals
from pacefold.streaming.router import Router

HOUR = timedelta(hours=1)


def frame(spark, rows):
    return spark.createDataFrame(rows, READINGS.schema).withColumn("topic", F.lit(READINGS.topic))


def store(spark, root, rows, batch_id, writer="w"):
    Router(parquet_sink(str(root), writer), live=LiveTotals(str(root), writer))(frame(spark, rows), batch_id)


def rows_of(frame):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in frame.collect()), key=str)


#: Batches of (user, rate, steps, calories, time).
BATCHES = [
    [("a", 70, 10, 1.5, "2024-01-01 10:00:00"), ("b", 80, 5, 2.5, "2024-01-01 23:59:59"), (None, 75, 1, 1.0, "2024-01-01 12:00:00")],
    [("a", 90, 7, 0.5, "2024-01-02 02:00:00"), ("a", None, None, None, "2024-01-01 11:00:00")],
    [("a", 100, 20, 4.0, "2024-01-01 12:00:00"), ("c", 60, 3, 1.0, "2024-01-01 08:00:00"), ("b", 70, 1, 1.0, "bad")],
    [("a", 50, 2, 0.5, "2024-01-02 03:00:00"), (None, 85, 2, 1.0, "2024-01-01 13:00:00"), ("c", 60, 3, 1.0, None)],
    [("d", 65, 4, 1.0, "2024-01-03 01:30:00"), ("b", 71, 9, 1.0, "2024-01-02 09:00:00")],
]


@pytest.fixture
def filled(spark, tmp_path):
    for number, rows in enumerate(BATCHES):
        store(spark, tmp_path, rows, number)
    return tmp_path


def all_rows(spark):
    return frame(spark, [row for batch in BATCHES for row in batch]).drop("topic")


def test_running_statistics_equal_those_of_all_rows(spark, filled):
    rows = all_rows(spark)
    for _ in range(2):
        found = live.reports(spark, str(filled), HOUR)
        assert rows_of(found["user_stats"]) == rows_of(readings.user_stats(rows))
        assert rows_of(found["daily_trends"]) == rows_of(readings.daily_trends(rows))
        assert rows_of(found["health_snapshot"]) == rows_of(readings.health_snapshot(rows))
        arguments = ["--tables", str(filled), "--retention-hours", "0"]
        compact.run(spark, compact.parse(arguments))


def test_a_replayed_batch_adds_nothing(spark, filled):
    before = rows_of(live.reports(spark, str(filled), HOUR)["corrected_days"])
    for number in (4, 4):
        store(spark, filled, BATCHES[number], number)
    assert rows_of(live.reports(spark, str(filled), HOUR)["corrected_days"]) == before


def test_days_and_corrections_equal_the_batch_roll_up(spark, filled):
    """Batch 1 closes the first of January; what batches 2 and 3 have of it is late."""
    found = live.reports(spark, str(filled), HOUR)
    told = {(row[0], row[4]): tuple(row)[1:4] for row in found["days"].collect()}
    assert told[("a", "2024-01-01")] == (10, 1.5, 70) and ("c", "2024-01-01") not in told
    signed = {(r.user_id, r.date, r.sign): (r.total_steps, r.avg_heart_rate, r.late_readings) for r in found["day_corrections"].collect()}
    assert signed == {
        ("a", "2024-01-01", -1): (10, 70, 1),
        ("a", "2024-01-01", 1): (30, 85, 1),
        ("c", "2024-01-01", 1): (3, 60, 1),
        (None, "2024-01-01", -1): (1, 75, 1),
        (None, "2024-01-01", 1): (3, 80, 1),
    }
    closed = F.col("date") < "2024-01-03"
    expected = rollups.daily_summary_rollup(all_rows(spark)).where(closed)
    assert rows_of(found["corrected_days"]) == rows_of(expected)
    late = report_reader(spark, str(filled))(running.LATE_READINGS)
    assert sorted(str(r.user_id) for r in late.collect()) == ["None", "a", "c"]


def test_lateness_does_not_depend_on_other_writers_or_replays(spark, filled):
    index = LiveTotals(str(filled), "w")
    assert index.closed_before(spark, ("w", 0)) is None
    assert str(index.closed_before(spark, ("w", 2))) == "2024-01-02 01:00:00+00:00"
    assert index.closed_before(spark, ("other", 7)) is None
    assert str(index.closed_before(spark)) == "2024-01-03 00:30:00+00:00"


def test_batches_without_times_leave_the_clock_alone(spark, tmp_path):
    store(spark, tmp_path, [("a", 1, 1, 1.0, "bad")], 0)
    assert LiveTotals(str(tmp_path), "w").closed_before(spark) is None
    assert set(live.reports(spark, str(tmp_path), HOUR)) == {"user_stats", "daily_trends", "health_snapshot"}
    store(spark, tmp_path, [("a", 1, 1, 1.0, "2024-01-05 00:00:00")], 1)
    assert str(LiveTotals(str(tmp_path), "w").closed_before(spark)) == "2024-01-04 23:00:00+00:00"


def test_alert_users_exact_and_sketched(spark):
    rows = spark.range(30_000).select(
        F.concat(F.lit("u"), F.col("id") % 7001).alias("user_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("alert_type")
    )
    parts = [rows.where(F.hash("user_id", "alert_type") % 4 == n) for n in range(-3, 4)]
    totals = parts[0].transform(alerts.condense)
    sketches = running.alert_sketches(parts[0])
    for part in parts[1:]:
        totals, sketches = totals.unionByName(alerts.condense(part)), sketches.unionByName(running.alert_sketches(part))
    found = {r.alert_type: r for r in running.alert_users(totals, running.merge_alert_sketches(sketches)).collect()}
    expected = {r.alert_type: r for r in rows.groupBy("alert_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u")).collect()}
    assert set(found) == set(expected) == {None, "t1", "t2"}
    for kind, row in found.items():
        assert (row.alerts, row.users) == (expected[kind].n, expected[kind].u)
        assert abs(row.estimated_users - row.users) < 0.03 * row.users


def test_the_jobs_keep_and_report_totals(spark, tmp_path):
    tables = {
        READINGS: [(f"u{n % 3}", 60 + n, n, 1.0, f"2024-01-0{1 + n % 4} 0{n % 9}:00:00") for n in range(30)],
        SUMMARIES: [(f"u{n % 3}", n, 1.0, 70, f"2024-01-0{1 + n % 4}") for n in range(9)],
        ALERTS: [(f"u{n % 4}", f"t{n % 2}", "m", "2024-01-01 00:00:00") for n in range(11)],
    }
    for feed in FEEDS:
        publish_to_files(spark.createDataFrame(tables[feed], feed.schema), feed, f"{tmp_path}/messages")
    arguments = ["--messages", f"{tmp_path}/messages", "--tables", f"{tmp_path}/tables", "--once"]
    arguments += ["--checkpoint", f"{tmp_path}/checkpoint", "--live", "1"]
    stream.start(spark, stream.parse(arguments)).awaitTermination()
    names = live.run(spark, live.parse(["--tables", f"{tmp_path}/tables", "--output", f"{tmp_path}/live"]))
    stored = load_tables(parquet_reader(spark, f"{tmp_path}/tables"))
    expected = {
        "user_stats": readings.user_stats(stored["readings"]),
        "user_performance": summaries.user_performance(stored["summaries"]),
        "overall_daily_stats": summaries.overall_daily_stats(stored["summaries"]),
        "alert_type_distribution": alerts.alert_type_distribution(stored["alerts"]),
        "user_alert_distribution": alerts.user_alert_distribution(stored["alerts"]),
    }
    assert set(expected) <= set(names)
    for name, frame_ in expected.items():
        assert rows_of(spark.read.parquet(f"{tmp_path}/live/{name}")) == rows_of(frame_)
