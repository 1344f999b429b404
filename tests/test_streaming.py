"""Streams over message files: routing, restarts, failures, windows, duplicates."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pacefold.feeds import ALERTS, ENVELOPE, FEEDS, READINGS, SUMMARIES
from pacefold.functions.times import with_event_time
from pacefold.operators import alerting, dedup, rollups
from pacefold.sinks.parallel import run_all
from pacefold.sinks.tables import (
    catalog_sink,
    create_catalog_tables,
    create_parquet_tables,
    parquet_sink,
)
from pacefold.sinks.topics import encode_messages, publish_to_files
from pacefold.sources.tables import catalog_reader, load_tables, parquet_reader
from pacefold.sources.topics import combined_stream, deduplicated, file_source, read_topic
from pacefold.streaming.router import QUARANTINE_TABLE, ROUTING_TABLE, Router, routing_totals
from pacefold.streaming.run import (
    AVAILABLE_NOW,
    last_watermark,
    run_and_watermark,
    run_to_table,
    start_batches,
    start_table,
)

READING_ROWS = [
    ("a", 70, 10, 1.0, "2024-01-01 00:00:00"),
    ("a", 90, 30, 3.0, "2024-01-01 00:10:00"),
]
SUMMARY_ROWS = [("a", 7000, 2000.5, 75, "2024-01-01")]
ALERT_ROWS = [
    ("b", "low_activity", "No activity detected in the last hour!", "2024-01-01 01:00:00")
]
ROWS = dict(zip(FEEDS, (READING_ROWS, SUMMARY_ROWS, ALERT_ROWS), strict=True))


def send(spark, root, feed, rows, first_offset=0):
    """Append rows as messages at consecutive broker positions."""
    numbered = [(*row, 0, first_offset + number) for number, row in enumerate(rows)]
    fields = [*feed.schema.fields, ENVELOPE["partition"], ENVELOPE["offset"]]
    frame = spark.createDataFrame(numbered, StructType(fields))
    encode_messages(frame.coalesce(1), feed).write.mode("append").parquet(
        f"{root}/messages/{feed.topic}"
    )


def send_all(spark, root):
    for feed, rows in ROWS.items():
        send(spark, root, feed, rows)


def route(spark, root, router=None):
    query = start_batches(
        combined_stream(spark, file_source(f"{root}/messages")),
        router or Router(parquet_sink(f"{root}/tables", label="w")),
        f"{root}/checkpoint",
        AVAILABLE_NOW,
    )
    query.awaitTermination()
    return query


def stored(spark, root, feed):
    table = parquet_reader(spark, f"{root}/tables")(feed)
    return sorted(tuple(row) for row in table.select(*feed.schema.fieldNames()).collect())


def test_mixed_batch_goes_to_its_tables(spark, tmp_path):
    send_all(spark, tmp_path)
    route(spark, tmp_path)
    for feed, rows in ROWS.items():
        assert stored(spark, tmp_path, feed) == sorted(rows)
        columns = parquet_reader(spark, f"{tmp_path}/tables")(feed).columns
        assert columns == [*feed.stored_schema.fieldNames(), "writer", "batch_id", "event_date"]
    totals = {
        (row.topic, row.target_table): row.row_count
        for row in routing_totals(spark, f"{tmp_path}/tables").collect()
    }
    assert totals == {(feed.topic, feed.table): len(rows) for feed, rows in ROWS.items()}


def test_batch_is_decoded_once_and_released(spark, tmp_path):
    levels = []

    def watching(rows, table, batch_id):
        levels.append(spark.sparkContext._jsc.getPersistentRDDs().size())

    batch = spark.createDataFrame(
        [(READINGS.topic, "a", 3)], "topic string, user_id string, steps int"
    )
    Router(watching, reports={})(batch, 0)
    assert levels == [1, 1]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_restart_handles_new_messages_only(spark, tmp_path):
    send_all(spark, tmp_path)
    route(spark, tmp_path)
    route(spark, tmp_path)
    assert stored(spark, tmp_path, READINGS) == sorted(READING_ROWS)
    more = [("c", 60, 5, 0.5, "2024-01-02 00:00:00")]
    send(spark, tmp_path, READINGS, more, first_offset=2)
    route(spark, tmp_path)
    assert stored(spark, tmp_path, READINGS) == sorted(READING_ROWS + more)
    assert stored(spark, tmp_path, ALERTS) == ALERT_ROWS


def test_batch_reports_see_their_batch_only(spark, tmp_path):
    send(spark, tmp_path, READINGS, READING_ROWS)
    for feed in (SUMMARIES, ALERTS):
        send(spark, tmp_path, feed, ROWS[feed])
    route(spark, tmp_path)
    send(spark, tmp_path, READINGS, [("a", 110, 50, 5.0, "2024-01-01 02:00:00")], 2)
    route(spark, tmp_path)
    reports = spark.read.parquet(f"{tmp_path}/tables/batch_user_stats").orderBy("batch_id")
    assert [(r.user_id, r.avg_steps, r.avg_heart_rate) for r in reports.collect()] == [
        ("a", 20.0, 80.0),
        ("a", 50.0, 110.0),
    ]
    snapshots = spark.read.parquet(f"{tmp_path}/tables/health_snapshot").orderBy("batch_id")
    assert [(r.max_heart_rate, r.min_heart_rate) for r in snapshots.collect()] == [
        (90, 70),
        (110, 110),
    ]


def test_failing_sink_stops_the_query_and_the_batch_comes_again(spark, tmp_path):
    send_all(spark, tmp_path)
    calls, failures = [], []
    write = parquet_sink(f"{tmp_path}/tables", label="w")

    def failing(rows, table, batch_id):
        calls.append((table, batch_id))
        write(rows, table, batch_id)
        if table == SUMMARIES.table and not failures:
            failures.append(table)
            raise OSError("store is down")

    router = Router(failing, reports={})
    with pytest.raises(StreamingQueryException, match="store is down"):
        route(spark, tmp_path, router)
    assert stored(spark, tmp_path, READINGS) == sorted(READING_ROWS)
    route(spark, tmp_path, router)
    tables = [ROUTING_TABLE, *(feed.table for feed in FEEDS)]
    assert sorted(calls) == sorted((table, 0) for table in tables * 2)
    for feed, rows in ROWS.items():
        assert stored(spark, tmp_path, feed) == sorted(rows)


def test_stream_into_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS streamed")
    create_catalog_tables(spark, "streamed", f"{tmp_path}/catalog")
    send_all(spark, tmp_path)
    router = Router(catalog_sink("w", "streamed"), parquet_sink(f"{tmp_path}/tables", "w"))
    route(spark, tmp_path, router)
    route(spark, tmp_path, router)
    tables = load_tables(catalog_reader(spark, "streamed"))
    for feed, rows in ROWS.items():
        fields = tables[feed.name].select(*feed.schema.fieldNames())
        assert sorted(map(tuple, fields.collect())) == sorted(rows)


def test_all_writes_are_tried_before_an_error_is_raised(spark):
    done = []

    def fail():
        raise OSError("down")

    with pytest.raises(OSError, match="down"):
        run_all(spark, [fail, lambda: done.append(spark.range(3).count())])
    assert done == [3]
    assert run_all(spark, []) == []
    assert run_all(spark, [lambda n=n: n for n in range(20)]) == list(range(20))


def test_unknown_topics_are_counted_and_not_stored(spark, tmp_path):
    batch = spark.createDataFrame(
        [("x", "a", 1), ("x", "b", 2), (READINGS.topic, "a", 3), (None, "c", 4)],
        "topic string, user_id string, steps int",
    )
    Router(parquet_sink(str(tmp_path), "w"), reports={})(batch, 7)
    counts = spark.read.parquet(f"{tmp_path}/{ROUTING_TABLE}")
    assert {(r.topic, r.target_table, r.row_count) for r in counts.collect()} == {
        ("x", None, 2),
        (None, None, 1),
        (READINGS.topic, READINGS.table, 1),
    }
    assert sorted(path.name for path in tmp_path.iterdir()) == [READINGS.table, ROUTING_TABLE]


def test_empty_batch_writes_no_rows(spark, tmp_path):
    batch = spark.createDataFrame([], "topic string, user_id string")
    Router(parquet_sink(str(tmp_path), "w"))(batch, 0)
    assert sorted(path.name for path in tmp_path.iterdir()) == [ROUTING_TABLE]
    assert spark.read.parquet(f"{tmp_path}/{ROUTING_TABLE}").count() == 0


def test_undecodable_messages_are_stored_with_nulls(spark, tmp_path):
    send_all(spark, tmp_path)
    bad = spark.createDataFrame([("garbage", READINGS.topic, 0, 99)], ENVELOPE)
    bad.write.mode("append").parquet(f"{tmp_path}/messages/{READINGS.topic}")
    route(spark, tmp_path)
    rows = parquet_reader(spark, f"{tmp_path}/tables")(READINGS).where("id like '%:99'").collect()
    assert [(row.user_id, row.steps) for row in rows] == [(None, None)]


def test_tables_exist_before_the_first_batch(spark, tmp_path):
    create_parquet_tables(spark, f"{tmp_path}/tables")
    tables = load_tables(parquet_reader(spark, f"{tmp_path}/tables"))
    assert {name: table.count() for name, table in tables.items()} == {
        feed.name: 0 for feed in FEEDS
    }
    send_all(spark, tmp_path)
    route(spark, tmp_path)
    create_parquet_tables(spark, f"{tmp_path}/tables")
    assert stored(spark, tmp_path, ALERTS) == ALERT_ROWS


def timed(spark, root, delay="1 hour"):
    return with_event_time(read_topic(spark, READINGS, file_source(f"{root}/messages")), delay)


@pytest.mark.parametrize("salt", [0, 4])
def test_copies_are_stored_once(spark, tmp_path, salt):
    """In one batch, and again in later batches after restarts; late ones too."""
    source = deduplicated(file_source(f"{tmp_path}/messages"), salt=salt)
    rows = [*READING_ROWS, ("c", 70, 1, 1.0, "bad"), ("c", 70, 1, 1.0, None)]
    for _ in range(3):
        send(spark, tmp_path, READINGS, rows)
    stored = run_to_table(read_topic(spark, READINGS, source), str(tmp_path))
    assert stored.count() == 4
    new = [("b", 70, 1, 1.0, "2024-01-01 00:20:00"), ("b", 70, 1, 1.0, "2001-01-01 00:00:00")]
    for _ in range(2):
        send(spark, tmp_path, READINGS, rows)
        send(spark, tmp_path, READINGS, new, len(rows))
        stored = run_to_table(read_topic(spark, READINGS, source), str(tmp_path))
    found = stored.select(*READINGS.schema.fieldNames()).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, rows + new))


def unplaced(spark, root, rows):
    """Messages as the publish job writes them, without broker positions."""
    publish_to_files(spark.createDataFrame(rows, READINGS.schema), READINGS, f"{root}/messages")


def test_messages_without_broker_position_are_told_apart(spark, tmp_path):
    rows = [("a", 70, n, 1.0, "2024-01-01 00:00:00") for n in range(3)]
    unplaced(spark, tmp_path, rows)
    source = file_source(f"{tmp_path}/messages")
    stored = run_to_table(read_topic(spark, READINGS, deduplicated(source)), f"{tmp_path}/one")
    ids = [row.id for row in stored.collect()]
    assert len(set(ids)) == 3 and all(len(i) <= 100 for i in ids)
    again = run_to_table(read_topic(spark, READINGS, source), f"{tmp_path}/two")
    assert sorted(row.id for row in again.collect()) == sorted(ids)


def test_a_message_without_any_position_is_refused(spark, tmp_path):
    """JSON files do not number their rows: no message may pass for another's copy."""
    rows = spark.createDataFrame(READING_ROWS, READINGS.schema)
    publish_to_files(rows, READINGS, f"{tmp_path}/messages", "json")
    source = deduplicated(file_source(f"{tmp_path}/messages", "json"))
    with pytest.raises(StreamingQueryException, match="cannot be told from others"):
        run_to_table(read_topic(spark, READINGS, source), str(tmp_path))
    with pytest.raises(Exception, match="cannot be told from others"):
        dedup.dedup(rows.withColumn("id", F.lit(None).cast("string"))).collect()


def test_checkpoints_of_one_table_folder_keep_apart(spark, tmp_path):
    create_parquet_tables(spark, f"{tmp_path}/tables")
    for part in "ab":
        rows = [(part, 70, n, 1.0, "2024-01-01 00:00:00") for n in range(5)]
        frame = spark.createDataFrame(rows, READINGS.schema)
        for feed in (SUMMARIES, ALERTS):
            send(spark, f"{tmp_path}/{part}", feed, [])
        publish_to_files(frame, READINGS, f"{tmp_path}/{part}/messages")
        start_batches(
            combined_stream(spark, file_source(f"{tmp_path}/{part}/messages")),
            Router(parquet_sink(f"{tmp_path}/tables")),
            f"{tmp_path}/checkpoint-{part}",
            AVAILABLE_NOW,
        ).awaitTermination()
    assert [row[0] for row in stored(spark, tmp_path, READINGS)] == ["a"] * 5 + ["b"] * 5


def test_quarantine_comes_from_the_stored_batch(spark, tmp_path):
    send_all(spark, tmp_path)
    bad = [("garbage", READINGS.topic, 0, 90), ('{"user_id":"a","steps":"x"}', READINGS.topic, 0, 91)]
    frame = spark.createDataFrame(bad, ENVELOPE)
    frame.write.mode("append").parquet(f"{tmp_path}/messages/{READINGS.topic}")
    for _ in range(2):
        start_batches(
            combined_stream(spark, file_source(f"{tmp_path}/messages"), graded=True),
            Router(parquet_sink(f"{tmp_path}/tables")),
            f"{tmp_path}/checkpoint",
            AVAILABLE_NOW,
        ).awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/tables/{QUARANTINE_TABLE}")
    assert sorted((r.id, r.value, r.grade) for r in kept.collect()) == [
        (f"{READINGS.topic}:0:90", "garbage", "undecodable"),
        (f"{READINGS.topic}:0:91", '{"user_id":"a","steps":"x"}', "partial"),
    ]
    rows = parquet_reader(spark, f"{tmp_path}/tables")(READINGS)
    joined = {r.id: (r.user_id, r.steps) for r in rows.join(kept.select("id"), "id").collect()}
    assert joined == {f"{READINGS.topic}:0:90": (None, None), f"{READINGS.topic}:0:91": ("a", None)}
    assert rows.count() == 4


def test_the_view_of_summaries_is_the_same_on_every_replay(spark, tmp_path):
    rows = [(f"u{n}", n, 1.0, 70, f"2024-01-{1 + n % 28:02}") for n in range(60)]
    frame = spark.createDataFrame(rows, SUMMARIES.schema).withColumn("topic", F.lit(SUMMARIES.topic))
    seen = []
    for parts in (1, 7):
        Router(parquet_sink(f"{tmp_path}/{parts}", "w"))(frame.repartition(parts), 0)
        view = spark.read.parquet(f"{tmp_path}/{parts}/summary_view")
        seen.append(sorted(map(tuple, view.select(*SUMMARIES.schema.fieldNames()).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 20
    assert min(row[4] for row in seen[0]) >= "2024-01-19"


def test_the_query_tells_its_watermark(spark, tmp_path):
    send(spark, tmp_path, READINGS, [("a", 70, 1, 1.0, "2024-01-03 12:00:00")])
    _, query = run_and_watermark(rollups.daily_summary_windows(timed(spark, tmp_path)), str(tmp_path))
    assert last_watermark(query).isoformat() == "2024-01-03T11:00:00+00:00"


def test_late_rows_are_left_out_by_windows(spark, tmp_path):
    send(spark, tmp_path, READINGS, [("a", 70, 1, 1.0, "2024-01-03 12:00:00")])
    operator = rollups.daily_summary_windows
    run_to_table(operator(timed(spark, tmp_path)), str(tmp_path))
    late = [("a", 70, 5, 1.0, "2024-01-01 00:00:00"), ("a", 70, 7, 1.0, "2024-01-05 12:00:00")]
    send(spark, tmp_path, READINGS, late, 1)
    rows = run_to_table(operator(timed(spark, tmp_path)), str(tmp_path))
    assert [(row.date, row.total_steps) for row in rows.collect()] == [("2024-01-03", 1)]


def spread_readings(days):
    start = datetime(2024, 1, 1)
    return [
        (
            f"u{number % 3}",
            60 + number % 40,
            number % 50,
            number / 4,
            str(start + timedelta(minutes=97 * number)),
        )
        for number in range(days * 24 * 60 // 97)
    ]


OPERATORS = {
    "daily": (rollups.daily_summary_rollup, rollups.daily_summary_windows, "date"),
    "hourly": (rollups.periodic_user_stats, rollups.periodic_user_stats, "window_start"),
    "sessions": (alerting.activity_sessions, alerting.stream_sessions, "session_end"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_stream_over_several_batches_equals_batch(spark, tmp_path, name):
    on_batch, on_stream, time_column = OPERATORS[name]
    rows = spread_readings(days=6)
    third = len(rows) // 3
    for part in range(3):
        send(spark, tmp_path, READINGS, rows[part * third : (part + 1) * third], part * third)
        start_table(
            on_stream(timed(spark, tmp_path)),
            f"{tmp_path}/out",
            f"{tmp_path}/checkpoint",
            AVAILABLE_NOW,
        ).awaitTermination()
    frame = spark.createDataFrame(rows[: 3 * third], READINGS.schema)
    batch = on_batch(frame)
    stream = spark.read.schema(batch.schema).parquet(f"{tmp_path}/out")
    watermark = datetime.fromisoformat(rows[3 * third - 1][4]) - timedelta(hours=1)
    ends = {
        "daily": F.date_add(F.to_date("date"), 1).cast("timestamp"),
        "hourly": F.col(time_column) + F.expr("INTERVAL 1 HOUR"),
        "sessions": F.col(time_column),
    }
    closed = batch.where(ends[name] <= F.lit(watermark))
    assert closed.count() > 10
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, closed.collect()))


def test_low_activity_on_a_stream_is_the_end_of_each_closed_session(spark, tmp_path):
    send(spark, tmp_path, READINGS, READING_ROWS + [("b", 70, 1, 1.0, "2024-01-02 00:00:00")])
    sessions = alerting.stream_sessions(timed(spark, tmp_path))
    rows = run_to_table(alerting.stream_low_activity(sessions), str(tmp_path))
    assert [tuple(row) for row in rows.collect()] == [("a", datetime(2024, 1, 1, 0, 10))]


def test_high_heart_rate_alerts_on_a_stream(spark, tmp_path):
    send(spark, tmp_path, READINGS, READING_ROWS + [("b", 140, 1, 1.0, "t")])
    stream = read_topic(spark, READINGS, file_source(f"{tmp_path}/messages"))
    rows = run_to_table(alerting.high_heart_rate_alerts(stream), str(tmp_path))
    assert [(row.user_id, row.timestamp) for row in rows.collect()] == [("b", "t")]


def test_one_large_file_is_decoded_by_several_tasks(spark, tmp_path):
    """A micro-batch of one file with one row group; a small one stays with one task."""
    rows = spark.range(150_000).selectExpr(
        "concat('u', id) AS user_id", "70 AS heart_rate", "CAST(id AS int) AS steps", "rand(5) AS calories",
        "'2024-01-01 00:00:00' AS timestamp",
    )
    for name, part in (("large", rows), ("small", rows.limit(20))):
        publish_to_files(part.coalesce(1), READINGS, f"{tmp_path}/{name}")
    tasks, stored = {}, {}

    def run(name, **options):
        def note(batch, batch_id):
            label = f"{name}{len(options)}"
            tasks[label] = batch.rdd.getNumPartitions()
            stored[label] = {(r.id, r.user_id) for r in batch.select("id", "user_id").collect()}

        source = file_source(f"{tmp_path}/{name}", maxFilesPerTrigger="1", **options)
        stream = read_topic(spark, READINGS, source)
        start_batches(stream, note, f"{tmp_path}/{name}-{len(options)}", AVAILABLE_NOW).awaitTermination()

    for name in ("large", "small"):
        run(name)
        run(name, spread=True)
    assert tasks["large1"] > tasks["large0"] and tasks["small1"] <= 1, tasks
    assert stored["large1"] == stored["large0"] and len(stored["large1"]) == 150_000
    assert stored["small1"] == stored["small0"]
