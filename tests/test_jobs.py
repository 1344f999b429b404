"""The command-line jobs, one after another: publish, stream, batch."""

import pytest

from pacefold.feeds import ALERTS, ENVELOPE, FEEDS, READINGS
from pacefold.jobs import alerts, batch, compact, publish, stream
from pacefold.operators.alerting import derived_alerts
from pacefold.plans import fixtures
from pacefold.sinks.topics import publish_to_files
from pacefold.sources.tables import load_tables, parquet_reader

SF_DIR = "/root/testdata/sf0.001"


def test_from_rows_to_reports(spark, tmp_path):
    sizes = {}
    for feed in FEEDS:
        rows = fixtures.table(spark, SF_DIR, feed)
        rows.write.parquet(f"{tmp_path}/rows/{feed.name}")
        sizes[feed.name] = rows.count()
        arguments = ["--feed", feed.name, "--rows", f"{tmp_path}/rows/{feed.name}"]
        publish.run(spark, publish.parse([*arguments, "--messages", f"{tmp_path}/messages"]))

    arguments = ["--messages", f"{tmp_path}/messages", "--tables", f"{tmp_path}/tables"]
    arguments += ["--checkpoint", f"{tmp_path}/checkpoint", "--once"]
    bad = [("garbage", feed.topic, 0, -1) for feed in FEEDS]
    for row in bad:
        frame = spark.createDataFrame([row], ENVELOPE)
        frame.write.mode("append").parquet(f"{tmp_path}/messages/{row[1]}")
    for _ in range(2):
        assert len(spark.streams.active) == 0
        query = stream.start(spark, stream.parse(arguments))
        assert [active.id for active in spark.streams.active] in ([query.id], [])
        query.awaitTermination()

    kept = spark.read.parquet(f"{tmp_path}/tables/quarantine").collect()
    assert sorted((row.value, row.topic) for row in kept) == sorted(
        ("garbage", feed.topic) for feed in FEEDS
    )
    compact.run(spark, compact.parse(["--tables", f"{tmp_path}/tables"]))

    arguments = ["--tables", f"{tmp_path}/tables", "--output", f"{tmp_path}/reports"]
    arguments += ["--scratch", f"{tmp_path}/scratch", "--as-of", "2024-03-01"]
    written = batch.run(spark, batch.parse(arguments))
    assert not (tmp_path / "scratch").exists()
    silent = spark.read.parquet(written["low_activity_gaps"]).where("next_time IS NULL")
    assert silent.count() == 15
    counts = spark.read.parquet(written["table_row_counts"]).collect()
    assert {row.table_name: row.row_count - 1 for row in counts} == sizes
    users = spark.read.parquet(written["user_stats"])
    assert users.count() == 15 + 1  # and the null user of the message that is garbage


def test_one_query_per_feed(spark, tmp_path):
    for feed in FEEDS:
        rows = fixtures.table(spark, SF_DIR, feed)
        publish_to_files(rows, feed, f"{tmp_path}/messages", "json")
    for name in ("readings", "alerts"):
        arguments = ["--messages", f"{tmp_path}/messages", "--format", "json", "--feeds", name]
        arguments += ["--tables", f"{tmp_path}/tables", "--label", name, "--once"]
        arguments += ["--checkpoint", f"{tmp_path}/checkpoint-{name}"]
        stream.start(spark, stream.parse(arguments)).awaitTermination()
    tables = load_tables(parquet_reader(spark, f"{tmp_path}/tables"))
    assert {name: table.count() for name, table in tables.items()} == {
        "readings": 1000,
        "summaries": 0,
        "alerts": fixtures.alerts(spark, SF_DIR).count(),
    }
    writers = tables["alerts"].select("writer").distinct().collect()
    assert [row.writer.partition("-")[0] for row in writers] == ["alerts"]


def test_from_messages_to_derived_alerts(spark, tmp_path):
    """Readings are stored, alerts derived from them, published, and stored as a feed."""
    for feed in FEEDS:
        rows = fixtures.table(spark, SF_DIR, feed)
        rows = rows if feed is READINGS else rows.limit(0)
        publish_to_files(rows, feed, f"{tmp_path}/messages")
    arguments = ["--messages", f"{tmp_path}/messages", "--tables", f"{tmp_path}/tables"]
    arguments += ["--checkpoint", f"{tmp_path}/checkpoint", "--once", "--dedup", "1 hour"]
    stream.start(spark, stream.parse(arguments)).awaitTermination()
    target = ["--tables", f"{tmp_path}/tables", "--messages", f"{tmp_path}/messages"]
    alerts.run(spark, alerts.parse([*target, "--goal", "500", "--days", "2024-01-02"]))
    stream.start(spark, stream.parse(arguments)).awaitTermination()
    stored = parquet_reader(spark, f"{tmp_path}/tables")(ALERTS)
    rows = fixtures.readings(spark, SF_DIR).where("timestamp LIKE '2024-01-02%'")
    expected = derived_alerts(rows, goal=500)
    fields = ALERTS.schema.fieldNames()
    found = sorted(map(tuple, stored.select(*fields).collect()))
    assert found and found == sorted(map(tuple, expected.select(*fields).collect()))
    assert {row[1] for row in found} == {"high_heart_rate", "low_activity", "goal_achieved"}


def test_database_is_read_once(spark, tmp_path, monkeypatch):
    """The database reader is replaced; every frame it hands out is read one time."""
    reads = []

    def reader(session, options, column, splits):
        assert (options, column, splits) == ({"url": "u"}, "batch_id", 8)

        def read(feed):
            reads.append(feed.name)
            rows = fixtures.table(session, SF_DIR, feed)
            return rows.select(*feed.schema.fieldNames())

        return read

    monkeypatch.setattr(batch, "jdbc_reader", reader)
    arguments = "--jdbc url=u --split-by batch_id --splits 8 --output".split()
    written = batch.run(spark, batch.parse([*arguments, f"{tmp_path}/reports"]))
    assert sorted(reads) == sorted(feed.name for feed in FEEDS)
    assert spark.read.parquet(written["user_stats"]).count() == 15


def test_options():
    options = stream.parse(
        "--bootstrap-servers b:1 --tables t --checkpoint c --jdbc url=jdbc:x --jdbc user=u".split()
    )
    assert dict(options.jdbc) == {"url": "jdbc:x", "user": "u"}
    with pytest.raises(SystemExit):
        batch.parse(["--output", "o"])
    files = "--messages m --tables t --checkpoint c".split()
    assert stream.parse([*files, "--max-files", "3"]).max_files == 3
    with pytest.raises(SystemExit):
        stream.parse([*files, "--max-offsets", "5"])
    with pytest.raises(SystemExit):
        stream.parse("--bootstrap-servers b --tables t --checkpoint c --max-files 3".split())
    assert batch.parse("--jdbc url=u --output o".split()).split_by == "batch_id"
    with pytest.raises(SystemExit):
        stream.parse("--bootstrap-servers b --tables t --checkpoint c --jdbc x".split())
