"""Kafka and JDBC calls, recorded instead of sent: neither can be started here."""

from unittest.mock import MagicMock, call

import pytest

from pacefold.feeds import ALERTS, READINGS
from pacefold.sinks.tables import create_jdbc_tables, jdbc_sink
from pacefold.sinks.topics import publish_to_kafka
from pacefold.sources.tables import jdbc_reader
from pacefold.sources.topics import kafka_source

DATABASE = {"url": "jdbc:x://host/db", "driver": "d", "user": "u", "password": "p"}


class Recorder:
    """A reader or writer that notes format, options, mode and the final call."""

    def __init__(self, result=None):
        self.calls = {}
        self.result = result

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def load(self):
        return self.result

    def save(self):
        self.calls["saved"] = True


class Recording:
    """Stands in for a session whose ``read`` gives a new recorder each time."""

    def __init__(self, *results):
        self.recorders = [Recorder(result) for result in results]
        self._next = iter(self.recorders)

    @property
    def read(self):
        return next(self._next)

    readStream = read


def bounds(low, high):
    frame = MagicMock()
    frame.first.return_value = (low, high)
    return frame


def test_kafka_stream():
    loaded = MagicMock()
    loaded.withColumnRenamed.return_value = "messages"
    session = Recording(loaded)
    source = kafka_source("b:9092", 500, minPartitions="64")
    assert source(session, READINGS.topic) == "messages"
    loaded.withColumnRenamed.assert_called_once_with("timestamp", "arrival")
    assert session.recorders[0].calls == {
        "format": "kafka",
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": READINGS.topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
        "minPartitions": "64",
    }


def test_kafka_publishing(spark, monkeypatch):
    recorder = Recorder()
    rows = spark.createDataFrame([("a", 1, 1, 1.0, "t")], READINGS.schema)
    seen = []
    monkeypatch.setattr(
        type(rows), "write", property(lambda frame: seen.append(frame.columns) or recorder)
    )
    publish_to_kafka(rows, READINGS, "b:9092", acks="all")
    assert seen == [["value", "topic"]]
    assert recorder.calls == {
        "format": "kafka",
        "kafka.bootstrap.servers": "b:9092",
        "acks": "all",
        "saved": True,
    }


@pytest.mark.parametrize(
    ("low", "high", "split"),
    [
        (
            1,
            9,
            {
                "partitionColumn": "id",
                "lowerBound": "1",
                "upperBound": "10",
                "numPartitions": "4",
            },
        ),
        (None, None, {}),
    ],
)
def test_database_table_is_read_in_ranges(low, high, split):
    session = Recording(bounds(low, high), "table")
    assert jdbc_reader(session, DATABASE, "id", 4)(ALERTS) == "table"
    first, second = (recorder.calls for recorder in session.recorders)
    assert first == {
        "format": "jdbc",
        **DATABASE,
        "query": "SELECT MIN(id) AS low, MAX(id) AS high FROM fitness_alerts",
    }
    assert second == {"format": "jdbc", **DATABASE, **split, "dbtable": ALERTS.table}


def test_database_table_without_split_column():
    session = Recording("table")
    assert jdbc_reader(session, DATABASE, None)(ALERTS) == "table"


def test_database_sink_appends_what_is_missing(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("t:0:1", "a", "x", "m", "t"), ("t:0:2", "b", "x", "m", "t")], ALERTS.stored_schema
    )
    stored = spark.createDataFrame(
        [("t:0:1", "w", 3), ("t:0:2", "w", 2), ("t:0:2", "v", 3)],
        "id string, writer string, batch_id bigint",
    )
    reader, writer, written = Recorder(stored), Recorder(), []
    monkeypatch.setattr(type(spark), "read", property(lambda _: reader))
    monkeypatch.setattr(
        type(rows),
        "write",
        property(lambda frame: written.extend(map(tuple, frame.collect())) or writer),
    )
    jdbc_sink(DATABASE, "w")(rows, ALERTS.table, 3)
    assert written == [("t:0:2", "b", "x", "m", "t", "w", 3)]
    assert writer.calls == {
        "format": "jdbc",
        **DATABASE,
        "dbtable": ALERTS.table,
        "mode": "append",
        "saved": True,
    }


def test_database_tables_are_created_once_each(spark, monkeypatch):
    writer = MagicMock()
    writer.format.return_value = writer
    writer.options.return_value = writer
    writer.option.return_value = writer
    writer.mode.return_value = writer
    frame_type = type(spark.range(1))
    monkeypatch.setattr(frame_type, "write", property(lambda _: writer))
    create_jdbc_tables(spark, DATABASE)
    tables = [c.args[1] for c in writer.option.call_args_list if c.args[0] == "dbtable"]
    assert tables == ["fitness_data", "daily_summaries", "fitness_alerts"]
    assert writer.mode.call_args_list == [call("ignore")] * 3
