"""Targets by repeated resharing, and what each document gives."""

from __future__ import annotations

from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from llm_reading import SF, rows_of, words_of

from pacefold.llm import mixing


def brute_targets(sizes):
    """Share by weight, stop at three times a source's size, reshare the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    targets, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), list(names)
    while left > 1e-9 and free:
        total = sum(weights[s] for s in free)
        for s in free:
            targets[s] += left * weights[s] / total
        left = sum(max(0.0, targets[s] - 3 * sizes[s]) for s in free)
        targets = {s: min(t, 3.0 * sizes[s]) for s, t in targets.items()}
        free = [s for s in free if targets[s] < 3 * sizes[s]]
    return targets


def check(rows, result):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(words_of(text))
    targets = brute_targets(dict(sizes))
    source_of = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for doc_id, size, source_size, target, words in result:
        source = source_of[doc_id]
        assert source_size == sizes[source] and target == pytest.approx(targets[source])
        assert 0 <= words <= 3 * size
        taken[source] += words
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6
    assert sorted((r[0], r[1]) for r in result) == sorted((r[0], len(words_of(r[1]))) for r in rows)


def test_whole_table(spark):
    rows = [tuple(r.values())[:4] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    result = rows_of(mixing.op8(frame))
    check(rows, result)
    assert sorted(result) == sorted(rows_of(mixing.op8(frame.repartition(7))))


def test_sources_that_stop(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10)
    rows = [(i, "w " * (i % 7), "en", "big") for i in range(600)]
    rows += [(1000 + i, "w " * (i + 1), "en", f"s{i:02}") for i in range(12)]
    rows += [(2000, "a b c", "en", None), (2001, None, "en", None), (2002, "", "en", "empty"), (2003, "w " * 40_000, "en", "zz"), (2004, "É b", "en", "é")]
    check(rows, rows_of(mixing.op8(docs(rows))))


def test_edges(docs):
    assert rows_of(mixing.op8(docs([]))) == []
    assert rows_of(mixing.op8(docs([(1, None)]))) == [(1, 0, 0, 0.0, 0)]
    frame = docs([(1, "a b"), (1, "a b"), (None, "c d e f")])
    for name in ("size", "target", "weight", "_slice", "position"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    result = rows_of(mixing.op8(frame))
    assert sorted(r[1] for r in result) == [2, 2, 4] and sum(r[4] for r in result) == 8


def test_order_follows_the_schedules(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix(frame)
    order = mixing.training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(0 <= r.position <= 1 for r in order)
    assert sum(r.words for r in order) == sum(r.taken for r in mixed.collect())
    # the words of a source read up to a time follow its schedule
    slopes = {r.source: r.slope for r in mixed.collect()}
    for source in ("src0", "src1", "src2"):
        own = [r for r in order if r.source == source]
        early = sum(r.words for r in own if r.position < 0.5) / sum(r.words for r in own)
        assert early == pytest.approx(0.5 - slopes[source] / 4, abs=0.25)


def test_position_inverts_the_demand(spark):
    for slope in mixing.SLOPES:
        frame = spark.range(0, 1001).selectExpr("id / 1000.0D AS t", f"{slope}D AS slope")
        demand = "20.0D * ((1 - slope) * t + slope * t * t)"
        rows = (
            frame.selectExpr("t", "slope", f"{demand} AS c", "20.0D AS target")
            .withColumn("found", mixing.position(*(mixing.F.col(c) for c in ("c", "target", "slope"))))
            .collect()
        )
        assert all(abs(r.t - r.found) < 1e-9 for r in rows)


def test_taken_is_what_the_copies_in_training_order_give(docs, monkeypatch):
    rows = [(i // 2, "w " * (i % 5), "en", f"s{i % 3}") for i in range(60)]
    rows += [(None, "a b c", "en", None), (None, "a b c", "en", None), (None, "d e", "en", "s0")]
    frame = docs(rows)
    placed = sorted((r.doc_id or -1, r.size, r.taken) for r in mixing.mix(frame).collect())
    assert sorted((r[0] or -1, r[1], r[4]) for r in rows_of(mixing.op8(frame))) == placed
    whole = mixing.training_order
    monkeypatch.setattr(mixing, "training_order", lambda mixed: whole(mixed).where("copy = 0"))
    firsts = rows_of(mixing.op8(frame))
    assert sum(r[4] for r in firsts) < sum(t for *_, t in placed)
    assert len(firsts) == len(rows) and all(r[4] <= r[1] for r in firsts)
