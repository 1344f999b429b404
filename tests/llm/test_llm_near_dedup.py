"""Near duplicates against all pairs of a small table."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from llm_reading import SF, rows_of, shingles_of

from pacefold.llm import near_dedup


def brute(rows):
    """Components from every pair of full sets."""
    sets = {i: shingles_of(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            low, high = sorted((len(sets[a]), len(sets[b])))
            if not low or 100 * low < 85 * high:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (low + high - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def found(frame):
    return {row[0]: row[1:] for row in rows_of(near_dedup.op5(frame))}


def test_whole_table_against_brute_force(spark):
    rows = [
        (r["doc_id"], r["text"])
        for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    ]
    expected = brute(rows)
    assert any(not kept for _, _, kept in expected.values())
    assert found(spark.read.parquet(f"{SF}/documents.parquet")) == expected


@pytest.mark.parametrize("part", [1_000_000, 300])
def test_chains_and_groups_around_the_threshold(docs, monkeypatch, part):
    """Chains of small changes, so that many members are linked only through others.

    Small parts cut every star into several, whose strangers meet ring by ring.
    """
    monkeypatch.setattr(near_dedup, "PART_SHINGLES", part)
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, next_id = [], 0
    for size in (6, 12, 40, 150):
        for _ in range(3):
            text = [pick.choice(vocabulary) for _ in range(size)]
            for _ in range(25):
                rows.append((next_id, " ".join(text)))
                next_id += 1
                text = list(text)
                for _ in range(pick.randrange(1 + size // 25)):
                    text[pick.randrange(size)] = pick.choice(vocabulary)
                if pick.random() < 0.3:
                    text.append(pick.choice(vocabulary))
    pick.shuffle(rows)
    assert found(docs(rows)) == brute(rows)


def test_edges(docs):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "one two three"),
        (7, "a b c d e"), (8, "A b\tc d\ne"), (9, "a b c d e f"), (10, "ÄB c"), (11, "äB c"),
        (12, "a " * 30_000), (13, "a " * 20_000),
    ]
    assert found(docs(rows)) == brute(rows)
    assert found(docs([])) == {}


def test_repeated_rows_and_missing_ids(docs):
    text = "v w x y z " * 4
    result = rows_of(near_dedup.op5(docs([(3, text), (3, text), (2, text), (None, text)])))
    assert sorted(result, key=str) == sorted(
        [(3, 5, 2, False), (3, 5, 2, False), (2, 5, 2, True), (None, 5, None, True)], key=str
    )


def test_components_of_long_paths(spark):
    """A path whose ids go up and down must end in one component."""
    path = [((i * 7919) % 500, ((i + 1) * 7919) % 500) for i in range(499)]
    edges = spark.createDataFrame(path + [(1000, 1001)], "u long, v long")
    found = dict(rows_of(near_dedup.components(edges)))
    assert {found[n] for n in range(500)} == {0}
    assert found[1000] == found[1001] == 1000


def test_clashing_columns_are_ignored(docs):
    frame = docs([(1, "p q r s t"), (2, "p q r s t")])
    for name in ("rep", "n_shingles", "buckets", "members"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    assert found(frame) == {1: (1, 1, True), 2: (1, 1, False)}
