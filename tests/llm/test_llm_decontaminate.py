"""Contained items against exact containment of all pairs; only built-in functions."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from llm_reading import SF, rows_of, shingles_of

from pacefold.llm import decontaminate

ITEMS = "item_id long, text string"


def brute(rows, items):
    out = set()
    sets = [(i, shingles_of(t)) for i, t in rows if i is not None]
    for item, text in items:
        own = shingles_of(text)
        for doc_id, other in sets if own and item is not None else ():
            if 100 * len(own & other) >= 80 * len(own):
                out.add((doc_id, item, len(own), len(own & other), len(own & other) / len(own)))
    return sorted(out)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_whole_table(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
    rows = [tuple(r.values())[:2] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    items = [tuple(r.values()) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    expected = brute(rows, items)
    frame = decontaminate.op1(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    )
    assert expected and sorted(rows_of(frame)) == expected


def test_items_just_above_and_below(spark, docs):
    """Items of every size with so many words changed that some pass and some do not."""
    pick = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    items, rows = [], []
    for n, size in enumerate([1, 3, 4, 5, 6, 7, 9, 12, 20, 33, 64, 65, 130, 300] * 4):
        words = [pick.choice(vocabulary) for _ in range(size)]
        items.append((n, " ".join(words)))
        for _ in range(pick.randrange(size // 20 + 2)):
            words[pick.randrange(size)] = pick.choice(vocabulary)
        filler = [" ".join(pick.choice(vocabulary) for _ in range(pick.randrange(400))) for _ in "ab"]
        rows.append((n, filler[0] + "\n" + " ".join(words).upper() + "\t" + filler[1]))
        rows.append((1000 + n, " ".join(words)))
    result = sorted(rows_of(decontaminate.op1(docs(rows), spark.createDataFrame(items, ITEMS))))
    expected = brute(rows, items)
    assert result == expected
    assert 0 < len({r[1] for r in expected}) and any(r[4] < 1 for r in expected)


def test_edges(spark, docs):
    items = [(1, None), (2, ""), (3, "one two three"), (4, "A b c d e f"), (4, "a b c d e f"), (None, "p q r s t"), (5, " ")]
    rows = [(1, None), (2, ""), (3, "One two\tthree"), (4, "x a b c d e f y"), (4, "x a b c d e f y"), (None, "a b c d e f"), (5, "p q r s t"), (6, "one two three four five"), (7, "a b c d e f " * 30_000), (8, "Ä b c d e")]
    benchmark = spark.createDataFrame(items, ITEMS)
    frame = docs(rows)
    assert sorted(rows_of(decontaminate.op1(frame, benchmark))) == [(3, 3, 1, 1, 1.0), (4, 4, 2, 2, 1.0), (7, 4, 2, 2, 1.0)]
    assert rows_of(decontaminate.op1(docs([]), benchmark)) == []
    assert rows_of(decontaminate.op1(frame, benchmark.limit(0))) == []
    for name in ("words", "sketch", "item_id", "item_ids", "n"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
        benchmark = benchmark if name in ("item_id",) else benchmark.selectExpr("*", f"'x' AS {name}")
    assert len(rows_of(decontaminate.op1(frame, benchmark))) == 3
    clean = {r[0] for r in rows_of(decontaminate.decontaminate(docs(rows), spark.createDataFrame(items, ITEMS)))}
    assert clean == {None, 1, 2, 5, 6, 8}


def test_no_python_and_no_cross_join(spark, capsys):
    frame = decontaminate.op1(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    )
    frame.explain("formatted")
    plan = capsys.readouterr().out
    for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert word not in plan
