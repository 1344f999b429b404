"""Decoding, encoding and quarantine of single messages."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, ENVELOPE, FEEDS, READINGS, SUMMARIES
from pacefold.sinks.topics import encode_messages, publish_to_files
from pacefold.sources.topics import (
    decode_messages,
    file_batch,
    file_source,
    kafka_options,
    quarantine,
    read_topic,
    union_feeds,
)
from pacefold.streaming.run import run_to_table

CASES = [
    # payload, decoded fields (user, rate, steps, calories, timestamp), grade
    ('{"user_id":"a","heart_rate":70}', ("a", 70, None, None, None), None),
    ('{"user_id":"a","x":1}', ("a", None, None, None, None), None),
    ("{}", (None, None, None, None, None), None),
    ('{"user_id":"a","heart_rate":"80","calories":5}', ("a", None, None, 5.0, None), "partial"),
    ('{"user_id":"a","heart_rate":72.5,"steps":3}', ("a", None, 3, None, None), "partial"),
    ('{"user_id":"a","heart_rate":99999999999,"steps":3}', ("a", None, 3, None, None), "partial"),
    ('{"user_id":7}', ("7", None, None, None, None), None),
    ('{"heart_rate":"80"}', (None, None, None, None, None), "undecodable"),
    ("garbage", (None, None, None, None, None), "undecodable"),
    ('{"user_id":"a","heart_ra', (None, None, None, None, None), "undecodable"),
    ('[{"user_id":"a"}', (None, None, None, None, None), "undecodable"),
    ("[1, 2]", (None, None, None, None, None), "undecodable"),
    ("", (None, None, None, None, None), "undecodable"),
    (None, (None, None, None, None, None), "undecodable"),
]


def messages(spark, values, topic=READINGS.topic):
    rows = [(value, topic, 0, number) for number, value in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def test_decoding_keeps_every_message(spark):
    decoded = decode_messages(messages(spark, [case[0] for case in CASES]), READINGS)
    assert decoded.columns == ["id", *READINGS.schema.fieldNames(), "topic"]
    by_id = {row.id: tuple(row)[1:-1] for row in decoded.collect()}
    for number, (_, fields, _) in enumerate(CASES):
        assert by_id[f"{READINGS.topic}:0:{number}"] == fields


def test_quarantine_grades(spark):
    graded = quarantine(messages(spark, [case[0] for case in CASES]), READINGS)
    expected = sorted(((case[0], case[2]) for case in CASES if case[2]), key=repr)
    assert sorted(((row.value, row.grade) for row in graded.collect()), key=repr) == expected


def test_payload_may_be_bytes(spark):
    raw = messages(spark, ['{"user_id":"a","steps":4}']).withColumn(
        "value", F.col("value").cast("binary")
    )
    assert decode_messages(raw, READINGS).first().steps == 4


def test_other_topics_are_left_out(spark):
    both = messages(spark, ['{"user_id":"a"}']).union(
        messages(spark, ['{"user_id":"b"}'], ALERTS.topic)
    )
    assert [row.user_id for row in decode_messages(both, ALERTS).collect()] == ["b"]


def test_without_broker_position_there_is_no_id(spark):
    raw = messages(spark, ['{"user_id":"a"}']).select("value", "topic")
    assert "id" not in decode_messages(raw, READINGS).columns


ROWS = {
    READINGS.name: [("a", 70, 3, 1.25, "2024-01-01 00:00:00"), (None, None, None, None, None)],
    SUMMARIES.name: [("a", 7000, 1.5, 70, "2024-01-01"), ("ü\"x\\", None, 0.1, None, "")],
    ALERTS.name: [("a", "low_activity", "tab\t and\nline", "2024-01-01 00:00:00")],
}


@pytest.mark.parametrize("feed", FEEDS, ids=lambda feed: feed.name)
@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_publishing_then_decoding_is_identity(spark, tmp_path, feed, file_format):
    rows = spark.createDataFrame(ROWS[feed.name], feed.schema)
    publish_to_files(rows, feed, str(tmp_path), file_format)
    back = read_topic(spark, feed, file_batch(str(tmp_path), file_format))
    fields = back.select(*feed.schema.fieldNames())
    assert fields.schema == feed.schema
    assert sorted(map(tuple, fields.collect()), key=repr) == sorted(
        ROWS[feed.name], key=repr
    )


any_reading = st.tuples(
    st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
    st.none() | st.integers(-(2**31), 2**31 - 1),
    st.none() | st.integers(-(2**31), 2**31 - 1),
    st.none() | st.floats(allow_nan=False, allow_infinity=False),
    st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(any_reading, min_size=1, max_size=40))
def test_any_values_survive(spark, rows):
    sent = encode_messages(spark.createDataFrame(rows, READINGS.schema), READINGS)
    texts = spark.createDataFrame(
        [tuple(row) for row in sent.collect()], "value string, topic string"
    )
    back = decode_messages(texts, READINGS).drop("topic")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    assert quarantine(texts, READINGS).count() == 0


def test_quarantine_on_a_stream(spark, tmp_path):
    values = [case[0] for case in CASES]
    messages(spark, values).write.parquet(f"{tmp_path}/messages/{READINGS.topic}")
    raw = file_source(f"{tmp_path}/messages")(spark, READINGS.topic)
    stored = run_to_table(quarantine(raw, READINGS), str(tmp_path))
    assert stored.count() == sum(1 for case in CASES if case[2])


def test_nulls_are_published(spark):
    rows = spark.createDataFrame([("a", None, None, None, None)], READINGS.schema)
    value = encode_messages(rows, READINGS).first().value
    assert value == (
        '{"user_id":"a","heart_rate":null,"steps":null,"calories":null,"timestamp":null}'
    )


def test_feeds_are_united_by_name(spark):
    frames = [
        spark.createDataFrame(ROWS[feed.name], feed.schema).withColumn(
            "topic", F.lit(feed.topic)
        )
        for feed in FEEDS
    ]
    united = union_feeds(frames)
    assert set(united.columns) == {
        "topic",
        *(name for feed in FEEDS for name in feed.schema.fieldNames()),
    }
    summary = united.where(F.col("topic") == SUMMARIES.topic).where("user_id = 'a'")
    summary = summary.first()
    assert (summary.total_steps, summary.heart_rate) == (7000, None)
    assert united.schema["heart_rate"].dataType.simpleString() == "int"
    # One topic reads one branch only.
    plan = united.where(F.col("topic") == ALERTS.topic)._jdf.queryExecution()
    assert "Union" not in plan.optimizedPlan().toString()


def test_kafka_options():
    options = kafka_options("broker:9092", READINGS.topic, 1000)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "fitness-topic",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
