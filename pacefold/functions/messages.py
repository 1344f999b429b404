"""Alert types and the sentence sent with each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert types and their messages.
HIGH_HEART_RATE = "high_heart_rate"
LOW_ACTIVITY = "low_activity"
GOAL_ACHIEVED = "goal_achieved"
ALERT_MESSAGES = {
    HIGH_HEART_RATE: "Heart rate is above normal range!",
    LOW_ACTIVITY: "No activity detected in the last hour!",
    GOAL_ACHIEVED: "Daily step goal achieved! Congratulations!",
}


def alert_message(alert_type: Column) -> Column:
    """Sentence for an alert type; null for a type without one."""
    pairs = [F.lit(part) for item in ALERT_MESSAGES.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), alert_type)
