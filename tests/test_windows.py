"""Keyed state and joined streams over several batches and restarts, and their job."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pacefold.feeds import READINGS, SUMMARIES
from pacefold.functions.times import timestamp_text, with_event_time
from pacefold.jobs import windows
from pacefold.operators import alerting, rollups
from pacefold.operators.reconcile import compare
from pacefold.sinks.topics import publish_to_files
from pacefold.sources.topics import file_source, read_topic
from pacefold.streaming.goals import stream_goals
from pacefold.streaming.reconcile import stream_compare, with_summary_time
from pacefold.streaming.run import run_to_table

START = datetime(2024, 1, 1)


def send(spark, root, rows, feed=READINGS):
    frame = spark.createDataFrame(rows, feed.schema)
    publish_to_files(frame.coalesce(1), feed, f"{root}/messages")


def reading(user, second, steps, rate=70):
    return (user, rate, steps, 1.0, str(START + timedelta(seconds=second)))


def timed(spark, root, delay="1 hour"):
    return with_event_time(read_topic(spark, READINGS, file_source(f"{root}/messages")), delay)


def goals(spark, root, goal):
    """One run over what is there; what all runs so far have emitted."""
    rows = run_to_table(stream_goals(timed(spark, root), goal), str(root))
    return sorted((tuple(r) for r in rows.select("user_id", "date", timestamp_text(F.col("time"))).collect()), key=str)


def test_goals_wait_until_nothing_earlier_can_come(spark, tmp_path):
    hour = 3600
    send(spark, tmp_path, [reading("a", 2 * hour, 60), reading("a", 3 * hour, 50), reading("b", hour, 99)])
    # the goal of 100 seems met at three; the watermark stands at two
    assert goals(spark, tmp_path, 100) == []
    # an earlier reading comes in time: it was met at two thirty already
    send(spark, tmp_path, [reading("a", 2 * hour + 1800, 45), reading("a", 3 * hour + 1800, 5)])
    found = [("a", "2024-01-01", "2024-01-01 02:30:00")]
    assert goals(spark, tmp_path, 100) == []
    # the watermark passes it, under a restarted query
    send(spark, tmp_path, [reading("c", 4 * hour, 1)])
    assert goals(spark, tmp_path, 100) == found
    # more of the same day changes nothing; another day counts anew
    send(spark, tmp_path, [reading("a", 5 * hour, 500), reading("b", 30 * hour, 100), reading("c", 60 * hour, 1)])
    found.append(("b", "2024-01-02", "2024-01-02 06:00:00"))
    assert goals(spark, tmp_path, 100) == found
    send(spark, tmp_path, [reading("c", 90 * hour, 1)])
    assert goals(spark, tmp_path, 100) == found


def test_goals_equal_the_batch_ones_on_closed_days(spark, tmp_path):
    pick = random.Random(3)
    rows = [
        (pick.choice(["a", "b", "c", None]), 70, pick.choice([None, -5, 0, 10, 40]), 1.0, str(START + timedelta(seconds=pick.randrange(4 * 86_400))))
        for _ in range(600)
    ]
    rows.sort(key=lambda r: (datetime.fromisoformat(r[4]) + timedelta(seconds=pick.randrange(3000))))
    rows += [("a", 70, 5, 1.0, "bad"), ("z", 70, 0, 1.0, str(START + timedelta(days=6)))]
    for part in range(4):
        send(spark, tmp_path, rows[part * 151 : part * 151 + 151])
        found = goals(spark, tmp_path, 300)
    frame = spark.createDataFrame(rows, READINGS.schema)
    expected = alerting.goals_achieved(frame, 300)
    assert len(found) >= 8
    wanted = expected.select("user_id", "date", timestamp_text(F.col("time"))).collect()
    assert found == sorted((tuple(r) for r in wanted), key=str)


@pytest.fixture
def both(spark, tmp_path):
    """Three batches of both topics: summaries that agree, differ, or have no other side."""
    days = {
        1: ([reading("a", 3600, 5), reading("b", 7200, 6), reading(None, 7300, 7)], [("a", 5, 1.0, 70, "2024-01-01"), ("b", 7, 1.0, 70, "2024-01-01"), (None, 7, 1.0, 70, "2024-01-01")]),
        2: ([reading("a", 90_000, 5)], [("a", 5, 1.0, 71, "2024-01-02"), ("x", 1, 1.0, 70, "2024-01-02")]),
        3: ([reading("r", 180_000, 5), reading("a", 500_000, 1)], [("a", 1, 1.0, 70, "2024-01-06")]),
    }

    def step(n):
        send(spark, tmp_path, days[n][0])
        send(spark, tmp_path, days[n][1], SUMMARIES)

    return step


def test_streams_are_compared_when_days_close(spark, tmp_path, both):
    for n in (1, 2, 3):
        both(n)
        told = with_summary_time(read_topic(spark, SUMMARIES, file_source(f"{tmp_path}/messages")), "1 hour")
        rows = run_to_table(stream_compare(timed(spark, tmp_path), told), str(tmp_path))
        found = sorted(((str(r.user_id), r.date, r.matches) for r in rows.collect()))
        if n == 1:
            assert found == []
    assert found == [
        ("None", "2024-01-01", True), ("a", "2024-01-01", True), ("a", "2024-01-02", False),
        ("b", "2024-01-01", False), ("r", "2024-01-03", False), ("x", "2024-01-02", False),
    ]


def test_the_job_goes_from_messages_to_differing_rows(spark, tmp_path, both):
    for n in (1, 2, 3):
        both(n)
        arguments = ["--messages", f"{tmp_path}/messages", "--output", f"{tmp_path}/out", "--once"]
        arguments += ["--checkpoint", f"{tmp_path}/checkpoints", "--goal", "5", "--limit", "69"]
        for query in windows.start(spark, windows.parse(arguments)):
            query.awaitTermination()
    out = {name: spark.read.parquet(f"{tmp_path}/out/{name}") for name in [*windows.OPERATORS, windows.RECONCILE]}
    differing = sorted((r.user_id, r.date, r.readings_total_steps, r.summaries_total_steps) for r in out["reconcile"].collect())
    assert differing == [("a", "2024-01-02", 5, 5), ("b", "2024-01-01", 6, 7), ("r", "2024-01-03", 5, None), ("x", "2024-01-02", None, 1)]
    rows = read_topic_batch(spark, tmp_path)
    days = rollups.daily_summary_rollup(rows).where("date < '2024-01-06'")
    checked = compare(days, out["days"], ["user_id", "date"], ["total_steps", "total_calories", "avg_heart_rate"])
    assert checked.count() == 5 and checked.where("NOT matches").count() == 0
    assert out["sessions"].count() == 5 and out["low_activity"].count() == 5
    assert out["high_heart_rate"].count() == 6
    assert out["hours"].agg(F.sum("readings")).first()[0] == 5
    assert sorted(str(r.user_id) for r in out["goals"].collect()) == ["None", "a", "a", "b", "r"]


def read_topic_batch(spark, root):
    from pacefold.sources.topics import decode_messages, file_batch

    return decode_messages(file_batch(f"{root}/messages")(spark, READINGS.topic), READINGS)
