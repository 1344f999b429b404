"""Reports over daily summaries, or over their totals from :func:`condense`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.feeds import SUMMARIES
from pacefold.functions.totals import mean, totals


def daily_summary_view(summaries: DataFrame) -> DataFrame:
    """The summary fields, without topic or storage columns."""
    return summaries.select(*SUMMARIES.schema.fieldNames())


def latest_summaries(summaries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` latest summaries; undated ones come last."""
    names = SUMMARIES.schema.fieldNames()
    others = [name for name in names if name != "date"]
    return daily_summary_view(summaries).orderBy(F.desc_nulls_last("date"), *others).limit(k)


_MEASURES = ("total_steps", "total_calories", "avg_heart_rate")


def condense(summaries: DataFrame) -> DataFrame:
    """Totals per user, which the reports below can be made from."""
    return totals(summaries, ["user_id"], _MEASURES, ("total_steps",))


def user_performance(summaries: DataFrame) -> DataFrame:
    """Per-user means over days, each day weighing the same; best users first."""
    means = [
        mean("total_steps", "avg_daily_steps"),
        mean("total_calories", "avg_daily_calories"),
        mean("avg_heart_rate", "avg_heart_rate"),
    ]
    per_user = totals(summaries, ["user_id"], _MEASURES).select("user_id", *means)
    return per_user.orderBy(F.desc_nulls_last("avg_daily_steps"), "user_id")


def overall_daily_stats(summaries: DataFrame) -> DataFrame:
    """Means and maximum over all user-days; one row, of nulls if there is no input."""
    return totals(summaries, [], _MEASURES, ("total_steps",)).select(
        mean("total_steps", "avg_total_steps"),
        mean("total_calories", "avg_total_calories"),
        mean("avg_heart_rate", "overall_avg_heart_rate"),
        "max_total_steps",
    )
