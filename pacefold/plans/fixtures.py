"""The three feeds, mapped from an ``events`` table.

Columns beyond the feed's fields (``partition``, ``offset``) are the broker
position a message would have.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.feeds import FEEDS, Feed
from pacefold.functions.messages import (
    GOAL_ACHIEVED,
    HIGH_HEART_RATE,
    LOW_ACTIVITY,
    alert_message,
)
from pacefold.functions.times import date_text, event_date, timestamp_text
from pacefold.sinks.parallel import run_all
from pacefold.sinks.topics import publish_to_files

TOPIC_PARTITIONS = 4

# Fixed value: decimals of calories in messages.
CALORIE_DECIMALS = 2

_ALERT_EVENTS = {
    "error": HIGH_HEART_RATE,
    "view": LOW_ACTIVITY,
    "purchase": GOAL_ACHIEVED,
}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positioned(
        _events(spark, sf_dir).select(
            _user(),
            (60 + F.col("event_id") % 91).cast("int").alias("heart_rate"),
            (_prop_k().try_cast("int") * 5).alias("steps"),
            F.col("value").alias("calories"),
            timestamp_text(F.col("ts")).alias("timestamp"),
            F.col("event_id").alias("offset"),
        )
    )


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positioned(
        readings(spark, sf_dir)
        .groupBy("user_id", event_date().alias("day"))
        .agg(
            F.sum("steps").alias("total_steps"),
            F.round(F.sum("calories"), CALORIE_DECIMALS).alias("total_calories"),
            F.round(F.avg("heart_rate")).cast("int").alias("avg_heart_rate"),
            F.min("offset").alias("offset"),
        )
        .withColumn("date", date_text(F.col("day")))
        .drop("day")
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [F.lit(part) for item in _ALERT_EVENTS.items() for part in item]
    alert_type = F.create_map(*pairs)[F.col("event_type")]
    return _positioned(
        _events(spark, sf_dir)
        .where(F.col("event_type").isin(list(_ALERT_EVENTS)))
        .select(
            _user(),
            alert_type.alias("alert_type"),
            alert_message(alert_type).alias("alert_message"),
            timestamp_text(F.col("ts")).alias("timestamp"),
            F.col("event_id").alias("offset"),
        )
    )


def flawed_messages(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """One reading message per event, spoilt in a way that depends on its type."""
    user = F.concat(F.lit('{"user_id":"'), _user(), F.lit('"'))
    kind = F.col("event_type")
    value = (
        F.when(kind == "click", F.concat(user, F.lit(',"heart_rate":70}')))
        .when(kind == "view", F.concat(user, F.lit(',"heart_rate":"70"}')))
        .when(kind == "error", F.concat(user, F.lit(',"heart_ra')))
        .when(kind == "signup", F.lit(""))
    )
    return _positioned(
        _events(spark, sf_dir).select(
            value.alias("value"), F.lit(feed.topic).alias("topic"), F.col("event_id").alias("offset")
        )
    )


def table(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    return {"readings": readings, "summaries": summaries, "alerts": alerts}[feed.name](
        spark, sf_dir
    )


def publish(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    feeds: tuple[Feed, ...] = FEEDS,
    positions: bool = True,
) -> None:
    """Publish feeds as message files under ``root``, with broker positions or without."""
    tables = [table(spark, sf_dir, feed) for feed in feeds]
    if not positions:
        tables = [rows.drop("partition", "offset") for rows in tables]
    run_all(
        spark,
        [partial(publish_to_files, rows, feed, root) for rows, feed in zip(tables, feeds, strict=True)],
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _user() -> Column:
    return F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id")


def _prop_k() -> Column:
    # Several times faster than parsing the whole JSON text for its one number.
    return F.regexp_extract("props", '"k": *([0-9]+)', 1)


def _positioned(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "partition", F.pmod("offset", F.lit(TOPIC_PARTITIONS)).cast("int")
    )
