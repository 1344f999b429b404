"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
from llm_reading import rows_of

from pacefold.llm import neighbours

SF = "/root/testdata/sf0.1"


def brute(rows, every=neighbours.QUERY_EVERY, k=neighbours.NEIGHBOURS):
    """Exact neighbours by id, with scores in double precision."""
    good = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None for x in vector):
            continue
        vector = np.array(vector, dtype=float)
        if np.isfinite(vector).all() and vector.any():
            good[vec_id] = vector
    out = {}
    for query, vector in good.items():
        if query % every:
            continue
        scores = [
            (-(v @ vector) / (np.linalg.norm(v) * np.linalg.norm(vector)), i)
            for i, v in good.items()
            if i != query and len(v) == len(vector)
        ]
        out[query] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(frame):
    out = {}
    for query, rank, vec_id, score in sorted(rows_of(neighbours.op7(frame))):
        out.setdefault(query, []).append((vec_id, score))
        assert rank == len(out[query])
    return out


def recall(result, expected):
    hits = [i for q, near in expected.items() for i, _ in near if i in {v for v, _ in result.get(q, [])}]
    return len(hits) / sum(len(near) for near in expected.values())


def test_recall_and_scores(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    expected = brute([(r["vec_id"], r["embedding"]) for r in table])
    result = found(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert set(result) == set(expected)
    assert recall(result, expected) >= 0.99
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in table}
    for query, near in result.items():
        for vec_id, score in near:
            a, b = vectors[query], vectors[vec_id]
            assert np.isclose(score, a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), atol=1e-12)


def test_error_bound_holds():
    pick = np.random.default_rng(3)
    vectors = neighbours.unit(pick.normal(size=(2000, 64)))
    codes, corrections = neighbours.encode(vectors)
    width = neighbours.BITS
    signs = (np.unpackbits(codes, axis=1).astype(float) * 2 - 1) / np.sqrt(width)
    estimate = (vectors[:50] @ neighbours.rotation(64).T) @ signs.T / corrections
    error = neighbours.SIGMAS * np.sqrt((1 - corrections**2) / corrections**2 / (width - 1))
    assert (np.abs(estimate - vectors[:50] @ vectors.T) <= error).mean() > 0.98


def test_small_blocks_give_the_same(spark, monkeypatch):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 600")
    whole = found(frame)
    for name, size in (("BLOCK_VECTORS", 100), ("BLOCK_QUERIES", 5), ("TILE_CODES", 32), ("TILE_QUERIES", 2)):
        monkeypatch.setattr(neighbours, name, size)
    assert {q: [i for i, _ in n] for q, n in found(frame).items()} == {
        q: [i for i, _ in n] for q, n in whole.items()
    }


def test_copies_ties_and_bad_vectors(spark):
    pick = np.random.default_rng(4)
    rows = [(i, [float(x) for x in pick.integers(-3, 4, 4)]) for i in range(200)]
    rows += [(i, [1.0, 2.0, 0.0, 1.0]) for i in range(200, 460)]  # a large group of copies
    rows += [(500, None), (550, [0.0] * 4), (600, [1.0, None, 1.0, 1.0]), (650, [float("nan")] * 4), (700, [float("inf"), 0.0, 0.0, 1.0])]
    rows += [(750, [1.0, 2.0]), (751, [2.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (800, [1.0] * 300), (3, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected, result = brute(rows), found(frame)
    assert set(result) == {q for q, near in expected.items() if near}
    for query, near in result.items():
        assert np.allclose([s for _, s in near], [s for _, s in expected[query]])
    # copies are exact ties: the smallest ids come first
    assert [i for i, _ in result[250]] == [200, 201, 202, 203, 204]
    assert [i for i, _ in result[200]] == [201, 202, 203, 204, 205]
    assert 800 not in result and [i for i, _ in result[750]] == [751]


def test_edges(spark):
    assert found(spark.createDataFrame([], "vec_id long, embedding array<float>")) == {}
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    for name in ("rep", "code", "score", "block", "label"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert list(found(frame)) == [0]
