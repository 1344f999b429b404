"""Step goals on a stream: one row per user and day, at the second the goal was met.

State is kept per user and month: the steps of each second of its open days, the
resolution of message timestamps. Readings come out of order, so a goal that seems to be
met at some second may have been met earlier. That second is therefore a candidate, with a
timeout; when the watermark passes it, nothing earlier can come any more, and the row is
emitted. It is the row that the batch operator finds, as early as it can be known. When a
day is over, what is left of its state is removed.

A call has some cost however few rows it is given, so a user's days of a month share one:
a backlog of a month is one call per user, not thirty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pacefold.functions.times import date_text, ensure_event_time

_ROW = "user_id string, second long"
#: Seconds of open days with their steps, and the open days whose goals are emitted.
_STATE = "seconds array<long>, steps array<long>, emitted array<long>"
_DAY_SECONDS = 86_400
#: Behind all readings of a second: theirs have its first instant.
_SECOND_END = 999


def stream_goals(readings: DataFrame, goal: int = 10000) -> DataFrame:
    """``user_id, date, time`` of the goals of a stream with a watermark.

    Equal to :func:`pacefold.operators.alerting.goals_achieved` on its readings, but for
    those that came behind the watermark. Readings without a time or steps count for
    nothing.
    """
    timed = ensure_event_time(readings).where("event_time IS NOT NULL AND steps IS NOT NULL")
    slots = timed.select(
        "user_id",
        F.trunc("event_time", "month").alias("month"),
        "event_time",
        F.floor(F.unix_micros("event_time") / 1_000_000).cast("long").alias("second"),
        F.col("steps").cast("long").alias("steps"),
    )
    met = slots.groupBy("user_id", "month").applyInPandasWithState(
        _goal_finder(goal), _ROW, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    time = F.timestamp_seconds("second")
    return met.select("user_id", date_text(F.to_date(time)).alias("date"), time.alias("time"))


def _goal_finder(goal: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def find(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else ([], [], [])
        seconds, steps, emitted = (np.array(values, dtype=np.int64) for values in kept)
        if not state.hasTimedOut:
            new = [(frame["second"].to_numpy(), frame["steps"].to_numpy()) for frame in frames]
            seconds, steps = _summed(
                np.concatenate([seconds, *(s for s, _ in new)]), np.concatenate([steps, *(n for _, n in new)])
            )
        # Nothing of a day is needed once its goal is emitted or it is over.
        wanted = np.isin(seconds // _DAY_SECONDS, emitted, invert=True)
        seconds, steps = seconds[wanted], steps[wanted]
        candidates = _met(seconds, steps, goal)
        watermark = state.getCurrentWatermarkMs()
        told = candidates * 1000 + _SECOND_END
        found = candidates[told < watermark]
        emitted = np.concatenate([emitted, found // _DAY_SECONDS])
        emitted = emitted[_ends(emitted) >= watermark]
        days = seconds // _DAY_SECONDS
        open_ = (_ends(days) >= watermark) & np.isin(days, emitted, invert=True)
        due = np.concatenate([told[told >= watermark], _ends(days[open_]), _ends(emitted)])
        if len(due):
            state.update((seconds[open_].tolist(), steps[open_].tolist(), emitted.tolist()))
            state.setTimeoutTimestamp(int(due.min()))
        elif state.exists:
            state.remove()
        if len(found):
            yield pd.DataFrame({"user_id": [key[0]] * len(found), "second": found})

    return find


def _ends(days: np.ndarray) -> np.ndarray:
    """The ends of days, in milliseconds."""
    return (days + 1) * (_DAY_SECONDS * 1000)


def _summed(seconds: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each second once, in order, with the sum of its steps."""
    each, place = np.unique(seconds, return_inverse=True)
    sums = np.zeros(len(each), dtype=np.int64)
    np.add.at(sums, place, steps)
    return each, sums


def _met(seconds: np.ndarray, steps: np.ndarray, goal: int) -> np.ndarray:
    """Of each day, the first of its seconds at which the running sum meets the goal."""
    days = seconds // _DAY_SECONDS
    total = np.cumsum(steps)
    begins = np.searchsorted(days, days)
    met = seconds[total - (total - steps)[begins] >= goal]
    return met[np.unique(met // _DAY_SECONDS, return_index=True)[1]]
