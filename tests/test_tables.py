"""Stored tables: replayed batches, catalog tables, database options, failed loads."""

import shutil
from datetime import UTC, datetime
from functools import partial
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, READINGS, SUMMARIES
from pacefold.session import new_scratch, shared_dir
from pacefold.sinks import compaction
from pacefold.sinks import tables as sinks
from pacefold.sinks.compaction import compact
from pacefold.sinks.parallel import run_all
from pacefold.sinks.versions import Version, expire, latest, publish
from pacefold.sources import tables as sources

ROWS = [("t:0:1", "a", "x", "m", "2024-01-01 00:00:00"), ("t:0:2", "b", "y", "m", None)]


def alerts(spark, rows=ROWS):
    return spark.createDataFrame(rows, ALERTS.stored_schema)


def test_replayed_batch_replaces_itself(spark, tmp_path):
    for writer in ("one", "two"):
        sink = sinks.parquet_sink(str(tmp_path), writer)
        sink(alerts(spark), ALERTS.table, 0)
        sink(alerts(spark), ALERTS.table, 1)
        sink(alerts(spark), ALERTS.table, 1)
    table = sources.parquet_reader(spark, str(tmp_path))(ALERTS)
    assert sorted({str(row.event_date) for row in table.collect()}) == ["2024-01-01", "None"]
    counts = table.groupBy("writer", "batch_id").count().collect()
    assert sorted(map(tuple, counts)) == [
        ("one", 0, 2),
        ("one", 1, 2),
        ("two", 0, 2),
        ("two", 1, 2),
    ]


def test_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS telemetry")
    sinks.create_catalog_tables(spark, "telemetry", str(tmp_path))
    sinks.create_catalog_tables(spark, "telemetry", str(tmp_path))
    sink = sinks.catalog_sink("w", "telemetry")
    sink(alerts(spark), ALERTS.table, 0)
    sink(alerts(spark), ALERTS.table, 1)
    sink(alerts(spark), ALERTS.table, 1)
    sink(alerts(spark).drop("id"), ALERTS.table, 0)
    read = sources.catalog_reader(spark, "telemetry")
    assert read(ALERTS).where("id is null").count() == 2
    assert read(ALERTS).count() == 4
    assert read(READINGS).count() == 0
    fields = read(SUMMARIES).drop("writer", "batch_id", "event_date").schema
    assert [f.dataType for f in fields] == [f.dataType for f in SUMMARIES.stored_schema]


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sources.load_tables(sources.parquet_reader(spark, str(tmp_path / "none")))


def test_stored_rows_are_skipped(spark):
    """What the database sink writes when half of a batch is already there."""
    rest = sinks.not_stored(alerts(spark), alerts(spark).where("id = 't:0:1'"))
    assert [tuple(row) for row in rest.collect()] == ROWS[1:]
    assert rest.columns == ALERTS.stored_schema.fieldNames()


def test_database_reads_are_split():
    assert sources.bounds_query("t", "id") == "SELECT MIN(id) AS low, MAX(id) AS high FROM t"
    assert sources.split_options("id", 8, 1, 100) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "101",
        "numPartitions": "8",
    }
    assert sources.split_options("id", 8, None, None) == {}
    with pytest.raises(ValueError, match="split by a number"):
        sources.split_options("id", 8, "t:0:1", "t:0:2")


def test_a_sink_outside_a_stream_needs_a_label(spark, tmp_path):
    with pytest.raises(ValueError, match="label"):
        sinks.parquet_sink(str(tmp_path))(alerts(spark), ALERTS.table, 0)


def test_rows_without_an_id_are_refused(spark):
    rows = alerts(spark, [(None, "a", "x", "m", None), (None, "b", "y", "m", None)])
    with pytest.raises(Exception, match="cannot be told from others"):
        sinks.not_stored(rows, alerts(spark).limit(0)).collect()


def test_days_are_pruned(spark, tmp_path):
    sinks.parquet_sink(str(tmp_path), "w")(alerts(spark), ALERTS.table, 0)
    rows = sources.parquet_reader(spark, str(tmp_path))(ALERTS).where("event_date = '2024-01-01'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert [row.id for row in rows.collect()] == ["t:0:1"]


def test_a_replay_leaves_no_days_of_the_first_try(spark, tmp_path):
    sink = sinks.parquet_sink(str(tmp_path), "w")
    sink(alerts(spark), ALERTS.table, 0)
    sink(alerts(spark, ROWS[1:]), ALERTS.table, 0)
    rows = sources.parquet_reader(spark, str(tmp_path))(ALERTS)
    assert [row.id for row in rows.collect()] == ["t:0:2"]


def many_batches(spark, root):
    for writer in ("v", "w"):
        sink = sinks.parquet_sink(root, writer)
        for batch in range(4):
            rows = [(f"{writer}:{batch}:{n}", "a", "x", "m", f"2024-01-0{1 + n % 3} 00:00:00") for n in range(5)]
            sink(alerts(spark, rows), ALERTS.table, batch)
    sinks.create_parquet_tables(spark, root)


def ids_of(spark, root, **at):
    return sorted(row.id for row in sources.parquet_reader(spark, root, **at)(ALERTS).collect())


def test_compaction_keeps_every_row_and_replays_safely(spark, tmp_path):
    root = str(tmp_path)
    many_batches(spark, root)
    table = sources.parquet_reader(spark, root)
    before = ids_of(spark, root)
    assert compact(spark, root, ALERTS.table) == 6
    assert ids_of(spark, root) == before
    assert expire(spark, f"{root}/{ALERTS.table}", 0) == 6
    assert ids_of(spark, root) == before
    assert {(r.writer, r.batch_id) for r in table(ALERTS).collect()} == {(w, b) for w in "vw" for b in range(4)}
    left = {str(p.relative_to(tmp_path / ALERTS.table).parent.parent) for p in (tmp_path / ALERTS.table).rglob("*.parquet")}
    assert left - {"writer=none/batch_id=-1"} == {"writer=v/batch_id=3", "writer=w/batch_id=3"} | {
        f"_merged/{p.name}" for p in (tmp_path / ALERTS.table / "_merged").iterdir() if p.is_dir()
    }
    # the newest batch is handed out again, and replaces itself alone
    sinks.parquet_sink(root, "w")(alerts(spark, [("w:3:9", "a", "x", "m", None)]), ALERTS.table, 3)
    expected = [i for i in before if not i.startswith("w:3:")] + ["w:3:9"]
    assert ids_of(spark, root) == sorted(expected)
    assert compact(spark, root, ALERTS.table) == 0


def test_days_of_merged_batches_are_pruned(spark, tmp_path):
    many_batches(spark, str(tmp_path))
    compact(spark, str(tmp_path), ALERTS.table)
    rows = sources.parquet_reader(spark, str(tmp_path))(ALERTS).where("event_date = '2024-01-01'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") == 2
    assert {row.timestamp for row in rows.collect()} == {"2024-01-01 00:00:00"}


def test_merged_folders_are_merged_again_when_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "FOLDERS", 2)
    root, sink = str(tmp_path), sinks.parquet_sink(str(tmp_path), "w")
    for batch in range(9):
        sink(alerts(spark, [(f"w:{batch}", "a", "x", "m", "2024-01-01 00:00:00")]), ALERTS.table, batch)
        if batch % 2 == 0:
            compact(spark, root, ALERTS.table)
    assert len(latest(spark, f"{root}/{ALERTS.table}").merged) <= 2
    assert ids_of(spark, root) == [f"w:{batch}" for batch in range(9)]


def test_an_interrupted_merge_is_never_seen(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path), f"{tmp_path}/{ALERTS.table}"
    many_batches(spark, root)
    before = ids_of(spark, root)
    with monkeypatch.context() as broken:
        broken.setattr(Version, "with_merged", MagicMock(side_effect=OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            compact(spark, root, ALERTS.table)
    assert ids_of(spark, root) == before
    assert compact(spark, root, ALERTS.table) == 6
    assert expire(spark, table, 0) == 7  # six batches, and what the lost run had written
    assert ids_of(spark, root) == before


def test_open_reports_and_old_versions_see_their_rows(spark, tmp_path):
    root = str(tmp_path)
    many_batches(spark, root)
    before, first = ids_of(spark, root), latest(spark, f"{root}/{ALERTS.table}")
    opened = sources.parquet_reader(spark, root)(ALERTS)
    compact(spark, root, ALERTS.table)
    sinks.parquet_sink(root, "w")(alerts(spark, [("late", "a", "x", "m", None)]), ALERTS.table, 4)
    expire(spark, f"{root}/{ALERTS.table}", 3600)
    assert sorted(row.id for row in opened.collect()) == before
    assert ids_of(spark, root, version=first.number) == before
    assert ids_of(spark, root, as_of=datetime.fromtimestamp(first.published / 1000, UTC)) == before
    assert ids_of(spark, root) == sorted([*before, "late"])
    with pytest.raises(ValueError, match="no version as old"):
        ids_of(spark, root, as_of=datetime(2020, 1, 1, tzinfo=UTC))


def test_an_unpublished_batch_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    many_batches(spark, root)
    before = ids_of(spark, root)
    rows = sinks.with_day(alerts(spark), ALERTS.table)
    rows.write.partitionBy("event_date").parquet(f"{root}/{ALERTS.table}/writer=w/batch_id=9")
    assert ids_of(spark, root) == before
    expire(spark, f"{root}/{ALERTS.table}", 0)
    assert (tmp_path / ALERTS.table / "writer=w/batch_id=9").exists()


def test_tables_without_versions_get_them(spark, tmp_path):
    root, folder = str(tmp_path), tmp_path / ALERTS.table
    many_batches(spark, root)
    before = ids_of(spark, root)
    shutil.rmtree(folder / "_versions")
    assert ids_of(spark, root) == before
    assert compact(spark, root, ALERTS.table) == 6
    assert ids_of(spark, root) == before


def test_two_who_publish_at_once_both_get_in(spark, tmp_path):
    table = f"{tmp_path}/t"
    steps = [partial(publish, spark, table, partial(Version.with_batch, batch=("w", n))) for n in range(12)]
    run_all(spark, steps)
    found = latest(spark, table)
    assert found.number == 12 and sorted(found.batches) == [("w", n) for n in range(12)]


def test_reports_are_compacted_too(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(3):
        sinks.parquet_sink(root, "7")(spark.createDataFrame([("t", batch)], "topic string, row_count long"), "topic_routing", batch)
    assert compaction.table_names(spark, root) == ["topic_routing"]
    assert compact(spark, root, "topic_routing") == 2
    expire(spark, f"{root}/topic_routing", 0)
    rows = sources.report_reader(spark, root)("topic_routing").collect()
    assert sorted(map(tuple, rows)) == [("t", n, "7", n) for n in range(3)]


def test_database_column_widths():
    assert sinks.jdbc_column_types(ALERTS) == (
        "`id` VARCHAR(100), `user_id` VARCHAR(20), `alert_type` VARCHAR(50), "
        "`timestamp` VARCHAR(30), `writer` VARCHAR(100)"
    )


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = new_scratch(spark, "x"), new_scratch(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))


def test_no_local_folder_on_a_cluster():
    session = MagicMock()
    session.conf.get.return_value = None
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        session.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session)


def test_stored_parquet_is_pruned(spark, tmp_path):
    sinks.parquet_sink(str(tmp_path), "w")(alerts(spark), ALERTS.table, 0)
    table = sources.parquet_reader(spark, str(tmp_path))(ALERTS)
    plan = (
        table.where(F.col("batch_id") == 0)
        .where(F.col("alert_type") == "x")
        .select("user_id")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "ReadSchema: struct<user_id:string,alert_type:string>" in plan
    assert "PushedFilters: [IsNotNull(alert_type), EqualTo(alert_type,x)]" in plan
    assert "PartitionFilters: [isnotnull(batch_id" in plan
