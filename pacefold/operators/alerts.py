"""Reports over alerts, or over their counts from :func:`condense`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS
from pacefold.functions.times import event_time
from pacefold.functions.totals import ROWS, is_condensed, totals


def alert_view(alerts: DataFrame) -> DataFrame:
    """The alert fields, without topic or storage columns."""
    return alerts.select(*ALERTS.schema.fieldNames())


def recent_alerts(alerts: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` latest alerts; alerts without a readable time come last."""
    return (
        alert_view(alerts)
        .orderBy(
            event_time().desc_nulls_last(),
            F.desc("timestamp"),
            "user_id",
            "alert_type",
            "alert_message",
        )
        .limit(k)
    )


def condense(alerts: DataFrame) -> DataFrame:
    """Counts per user and alert type, which the distributions can be made from."""
    return totals(alerts, ["user_id", "alert_type"])


def alert_type_distribution(alerts: DataFrame) -> DataFrame:
    """Alerts per type, commonest first; alerts without a type are a group too."""
    return (
        totals(alerts, ["alert_type"])
        .select("alert_type", F.col(ROWS).alias("count"))
        .orderBy(F.desc("count"), "alert_type")
    )


def user_alert_distribution(alerts: DataFrame) -> DataFrame:
    """Per user: all alerts, alerts with a type, and the number of different types.

    Counts per (user, type) first: whatever one user's share of the alerts, the
    second step sees one row per type.
    """
    counts = alerts if is_condensed(alerts) else condense(alerts)
    typed = F.sum(F.when(F.col("alert_type").isNotNull(), F.col(ROWS)))
    return (
        counts.groupBy("user_id")
        .agg(
            F.sum(ROWS).alias("total_alerts"),
            F.coalesce(typed, F.lit(0)).alias("typed_alerts"),
            F.count("alert_type").alias("unique_alert_types"),
        )
        .orderBy(F.desc("total_alerts"), "user_id")
    )
