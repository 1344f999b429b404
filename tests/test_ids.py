"""The id index: copies at any distance, lost checkpoints, pruned buckets, spans."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from pacefold.feeds import ALERTS, FEEDS, READINGS
from pacefold.functions.times import timestamp_text
from pacefold.jobs import compact, stream
from pacefold.sinks import files, versions
from pacefold.sinks.ids import BLOCK, BUCKETS, CELL, IDS_TABLE, SPANS, IdIndex, compact_ids, merged_spans, spans
from pacefold.sinks.tables import create_parquet_tables, parquet_sink
from pacefold.sinks.topics import publish_to_files
from pacefold.sources.tables import parquet_reader
from pacefold.sources.topics import combined_stream, file_source
from pacefold.streaming.router import Router
from pacefold.streaming.run import AVAILABLE_NOW, start_batches


def message(spark, root, user, hours_back=0, positions=True):
    """One reading in a file of its own, dated back."""
    row = (user, 70, 10, 1.0, "2024-01-01 00:00:00", 0, int(user[1:]))
    frame = spark.createDataFrame([row], [*READINGS.schema.fieldNames(), "partition", "offset"]).withColumn("partition", F.lit(0))
    folder = f"{root}/messages/{READINGS.topic}"
    before = set(files.file_names(spark, folder))
    publish_to_files(frame if positions else frame.drop("partition", "offset"), READINGS, f"{root}/messages")
    now = int(datetime.now(UTC).timestamp() * 1000)
    for name in set(files.file_names(spark, folder)) - before:
        files.set_changed_at(spark, f"{folder}/{name}", now - hours_back * 3_600_000)


def prepare(spark, root):
    for feed in FEEDS:
        empty = spark.createDataFrame([], feed.schema)
        publish_to_files(empty, feed, f"{root}/messages")


def run_job(spark, root, *more, checkpoint="checkpoint"):
    arguments = ["--messages", f"{root}/messages", "--tables", f"{root}/tables", "--once"]
    arguments += ["--checkpoint", f"{root}/{checkpoint}", *more]
    stream.start(spark, stream.parse(arguments)).awaitTermination()


def users(spark, root):
    rows = parquet_reader(spark, f"{root}/tables")(READINGS).collect()
    return sorted(row.user_id for row in rows)


@pytest.mark.parametrize("options", [["--dedup", "1 hour"], ["--known-ids"], ["--dedup", "1 hour", "--known-ids"]])
def test_late_files_lose_nothing(spark, tmp_path, options):
    prepare(spark, tmp_path)
    for user, hours in (("u1", 0), ("u2", 2), ("u3", 0)):
        message(spark, tmp_path, user, hours)
        run_job(spark, tmp_path, *options)
    assert users(spark, tmp_path) == ["u1", "u2", "u3"]


def test_copies_are_known_under_a_new_checkpoint_and_after_compaction(spark, tmp_path):
    prepare(spark, tmp_path)
    for n in range(1, 5):
        message(spark, tmp_path, f"u{n}")
        run_job(spark, tmp_path, "--known-ids")
    assert compact.run(spark, compact.parse(["--tables", f"{tmp_path}/tables", "--retention-hours", "0"])) > 0
    for n in (2, 5):
        message(spark, tmp_path, f"u{n}", hours_back=30)
    run_job(spark, tmp_path, "--known-ids", checkpoint="second")
    assert users(spark, tmp_path) == ["u1", "u2", "u3", "u4", "u5"]


def test_tables_written_without_the_index_are_caught_up(spark, tmp_path):
    prepare(spark, tmp_path)
    for n in (1, 2):
        message(spark, tmp_path, f"u{n}")
        run_job(spark, tmp_path)
    compact.run(spark, compact.parse(["--tables", f"{tmp_path}/tables"]))
    message(spark, tmp_path, "u3")
    run_job(spark, tmp_path, "--known-ids", checkpoint="second")
    assert users(spark, tmp_path) == ["u1", "u2", "u3"]
    assert IdIndex(f"{tmp_path}/tables").catch_up(spark) == 0


def test_a_query_that_ended_before_the_index_is_made_good(spark, tmp_path):
    """Its rows are stored, its ids are not, and its checkpoint is never used again."""
    prepare(spark, tmp_path)
    message(spark, tmp_path, "u1")
    create_parquet_tables(spark, f"{tmp_path}/tables")

    class Ends(IdIndex):
        def record(self, rows, batch_id):
            raise OSError("lost")

    messages = combined_stream(spark, file_source(f"{tmp_path}/messages"), graded=True)
    router = Router(parquet_sink(f"{tmp_path}/tables"), index=Ends(f"{tmp_path}/tables"))
    with pytest.raises(Exception, match="lost"):
        start_batches(messages, router, f"{tmp_path}/first", AVAILABLE_NOW).awaitTermination()
    assert users(spark, tmp_path) == ["u1"]
    run_job(spark, tmp_path, "--known-ids", checkpoint="second")
    assert users(spark, tmp_path) == ["u1"]


def test_a_replayed_batch_gets_the_same_rows(spark, tmp_path):
    index = IdIndex(str(tmp_path), "w")
    rows = spark.createDataFrame([(f"t:0:{n}", n) for n in (1, 2, 2, 7)], "id string, x long")
    for _ in range(2):
        new = index.unseen(rows, 0)
        assert sorted(row.id for row in new.collect()) == ["t:0:1", "t:0:2", "t:0:7"]
        index.record(new, 0)
    assert index.unseen(rows, 1).count() == 0
    with pytest.raises(Exception, match="cannot be told from others"):
        index.unseen(spark.createDataFrame([(None, 1)], "id string, x long"), 1).collect()


def test_ids_of_every_form(spark, tmp_path):
    index = IdIndex(str(tmp_path), "w")
    names = ["t:0:5", "t:1:5", "t:0:-5", "t:0:05x", ":3", "7", "", "t:0:999999999999999999999", "t:0:1000000000000", "ä:b:1"]
    rows = spark.createDataFrame([(name,) for name in names], "id string")
    index.record(rows, 0)
    assert index.unseen(rows, 1).count() == 0
    others = ["t:0:4", "t:2:5", "t:0:5x", "8", "t:0:999999999999999999998", "x:3"]
    fresh = spark.createDataFrame([(name,) for name in others], "id string")
    assert sorted(row.id for row in index.unseen(fresh, 1).collect()) == sorted(others)


def test_spans_join_what_touches(spark):
    rows = spark.createDataFrame([(f"t:0:{n}",) for n in [*range(10, 2000), 5, 6, 7, 2001, BLOCK - 1, BLOCK, BLOCK + 1]], "id string")
    found = sorted((r.low, r.high) for r in spans(rows).collect())
    assert found == [(5, 7), (10, 1999), (2001, 2001), (BLOCK - 1, BLOCK - 1), (BLOCK, BLOCK + 1)]
    parts = [("t", 0, a, b, 3) for a, b in [(1, 9), (2, 3), (10, 12), (14, 20), (15, 15), (22, 30)]]
    joined = merged_spans(spark.createDataFrame(parts, SPANS)).collect()
    assert sorted((r.low, r.high) for r in joined) == [(1, 12), (14, 20), (22, 30)]


def test_a_batch_reads_the_buckets_of_its_blocks_only(spark, tmp_path):
    index = IdIndex(str(tmp_path), "w")
    wide = spark.range(0, 400 * BLOCK, BLOCK // 4).select(F.concat(F.lit("t:0:"), "id").alias("id"))
    index.record(wide, 0)
    folder = f"{tmp_path}/{IDS_TABLE}/writer=w/batch_id=0"
    assert len(files.subfolders(spark, folder, "bucket=")) > BUCKETS // 2
    fresh = index.unseen(spark.createDataFrame([("t:0:1",), ("t:0:2",)], "id string"), 1)
    assert fresh.count() == 2
    scan = [line for line in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line and "bucket" in line]
    assert len(scan) == 1 and ("bucket" in scan[0].partition("PartitionFilters: [")[2].partition("]")[0])
    # one block, one bucket
    assert scan[0].partition("PartitionFilters: [")[2].partition("]")[0].count("bucket") == 2


def test_compaction_bounds_the_index(spark, tmp_path):
    index = IdIndex(str(tmp_path), "w")
    for batch in range(6):
        rows = spark.range(batch * 100, batch * 100 + 100).select(F.concat(F.lit("t:0:"), "id").alias("id"))
        index.record(rows, batch)
    assert index.known(spark).count() == 6
    assert compact_ids(spark, str(tmp_path)) == 5
    versions.expire(spark, f"{tmp_path}/{IDS_TABLE}", 0)
    assert sorted((r.low, r.high) for r in index.known(spark).collect()) == [(0, 499), (500, 599)]


def test_alerts_without_new_messages_write_no_rows(spark, tmp_path):
    prepare(spark, tmp_path)
    rows = spark.createDataFrame([("a", "x", "m", "2024-01-01 00:00:00", 0, 1)], [*ALERTS.schema.fieldNames(), "partition", "offset"]).withColumn("partition", F.lit(0))
    publish_to_files(rows, ALERTS, f"{tmp_path}/messages")
    for checkpoint in ("one", "two"):
        run_job(spark, tmp_path, "--known-ids", checkpoint=checkpoint)
    stored = parquet_reader(spark, f"{tmp_path}/tables")(ALERTS)
    assert stored.count() == 1
    assert stored.select(timestamp_text(F.col("event_date").cast("timestamp"))).first()[0] == "2024-01-01 00:00:00"


def test_numbers_with_gaps_are_not_compared_with_each_other(spark, tmp_path):
    index = IdIndex(str(tmp_path), "writer")
    known = {*range(0, 3 * CELL, 4), *range(CELL - 3, 2 * CELL + 5), 5 * CELL, *range(BLOCK - 2, BLOCK + 3)}
    ids = [(f"topic:0:{n}",) for n in known] + [("topic:1:9",), ("free",)]
    for batch, part in enumerate((ids[::2], ids[1::2])):
        index._record(spark.createDataFrame(part, "id string"), ("writer", batch))
    numbers = [*range(3 * CELL + 9), *range(5 * CELL - 2, 5 * CELL + 3), *range(BLOCK - 5, BLOCK + 6)]
    asked = [*(f"topic:0:{n}" for n in numbers), "topic:1:8", "topic:1:9", "topic:1:10", "free", "other", "other"]
    rows = spark.createDataFrame([(i, i) for i in asked], "`a.b` string, id string")
    found = index.unseen(rows, 2)
    # A join on the block, with a range on top, would compare all of a block's numbers with all its spans.
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == rows.columns
    wanted = set(asked) - {i for (i,) in ids}
    assert sorted(tuple(r) for r in found.collect()) == sorted((i, i) for i in wanted)
