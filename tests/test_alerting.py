"""Derived alerts and sessions against row-by-row brute force."""

import random
from datetime import datetime, timedelta
from itertools import groupby

import pytest

from pacefold.feeds import READINGS
from pacefold.operators import alerting

HOUR = timedelta(hours=1)


def frame_of(spark, rows):
    return spark.createDataFrame(
        [(user, rate, steps, 0.0, text) for user, rate, steps, text in rows],
        READINGS.schema,
    )


def random_rows(seed, start):
    """Three users, one of whom sends most readings, with equal times and bad ones."""
    draw = random.Random(seed)
    rows = []
    for _ in range(600):
        user = draw.choice(["hot", "hot", "hot", "b", None])
        time = start + timedelta(minutes=draw.randrange(0, 60 * 24 * 4, 10))
        rows.append((user, draw.randrange(60, 150), draw.randrange(-20, 100), str(time)))
    rows.append(("b", 70, 10, "bad"))
    rows.append(("hot", 70, 10, None))
    return rows


def by_user(rows):
    timed = [
        (user, datetime.fromisoformat(text), steps)
        for user, _, steps, text in rows
        if text and text != "bad"
    ]
    timed.sort(key=lambda row: (row[0] or "", row[1]))
    return {
        user: [(time, steps) for _, time, steps in group]
        for user, group in groupby(timed, key=lambda row: row[0])
    }


def expected_sessions(rows, gap):
    found = []
    for user, readings in by_user(rows).items():
        runs = []
        for time, _ in readings:
            if runs and time <= runs[-1][1] + gap:
                runs[-1][1] = time
                runs[-1][2] += 1
            else:
                runs.append([time, time, 1])
        found += [(user, first, last + gap, count) for first, last, count in runs]
    return found


def expected_gaps(rows, gap):
    return [
        (user, before[0], after[0])
        for user, readings in by_user(rows).items()
        for before, after in zip(readings, readings[1:])
        if after[0] - before[0] > gap
    ]


def expected_goals(rows, goal):
    found = []
    for user, readings in by_user(rows).items():
        for day, group in groupby(readings, key=lambda row: row[0].date()):
            total = 0
            for time, same_time in groupby(list(group), key=lambda row: row[0]):
                total += sum(steps for _, steps in same_time)
                if total >= goal:
                    found.append((user, day.isoformat(), time))
                    break
    return found


def collected(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("start", [datetime(2024, 1, 1), datetime(1969, 12, 30, 0, 0, 7)])
@pytest.mark.parametrize("gap_seconds", [3600, 1800, 2400])
def test_sessions_and_gaps(spark, start, gap_seconds):
    rows = random_rows(gap_seconds, start)
    gap = timedelta(seconds=gap_seconds)
    frame = frame_of(spark, rows)
    sessions = expected_sessions(rows, gap)
    assert collected(alerting.activity_sessions(frame, gap_seconds)) == sorted(sessions, key=repr)
    assert collected(alerting.stream_sessions(frame, gap_seconds)) == sorted(sessions, key=repr)
    assert collected(alerting.low_activity_gaps(frame, gap_seconds)) == sorted(
        expected_gaps(rows, gap), key=repr
    )


@pytest.mark.parametrize("goal", [1, 150, 400, 10**6])
def test_goals(spark, goal):
    rows = random_rows(goal, datetime(2024, 1, 1))
    assert collected(alerting.goals_achieved(frame_of(spark, rows), goal)) == sorted(
        expected_goals(rows, goal), key=repr
    )


def test_a_pause_of_exactly_the_gap_is_no_pause(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 01:59:59"]
    frame = frame_of(spark, [("a", 70, 1, time) for time in times])
    assert alerting.low_activity_gaps(frame).count() == 0
    session = alerting.activity_sessions(frame).collect()
    assert [(s.session_end, s.readings) for s in session] == [(datetime(2024, 1, 1, 2, 59, 59), 3)]


def test_high_heart_rate_is_strictly_above(spark):
    frame = frame_of(spark, [("a", rate, 1, "t") for rate in (99, 100, 101, None)])
    assert [tuple(row) for row in alerting.high_heart_rate_alerts(frame).collect()] == [
        ("a", "high_heart_rate", "Heart rate is above normal range!", "t")
    ]


@pytest.mark.parametrize(
    "operator",
    [alerting.activity_sessions, alerting.low_activity_gaps, alerting.goals_achieved],
)
def test_readings_are_combined_before_the_first_shuffle(spark, operator):
    """No task orders one user's raw readings, whatever the user's share."""
    frame = frame_of(spark, [("a", 70, 1, "2024-01-01 00:00:00")])
    plan = operator(frame)._jdf.queryExecution().executedPlan().toString().splitlines()
    # The plan lists the scan last: going up from it, aggregate comes before exchange.
    steps = [
        word
        for line in reversed(plan)
        for word in ("partial_", "Exchange", "Window")
        if word in line
    ]
    assert steps[:2] == ["partial_", "Exchange"]
    assert "Window" in steps
