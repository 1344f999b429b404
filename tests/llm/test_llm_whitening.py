"""Whitening against numpy's eigenvectors and exact integers; the slicing on hard spectra."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm_reading import SF, rows_of

from pacefold.llm import spectrum, whitening


def brute(rows, components=32):
    """``(vec_id, whitened by component, deviation, explained)`` of equally long vectors."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = ((x * n - sums) / n).astype(np.float64)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    some = values > 1e-12 * values.sum()
    white = centred @ vectors[:, some] / np.sqrt(values[some])
    deviations = ((x * n - sums) ** 2).sum(axis=1).tolist()
    return [i for i, _ in kept], white, deviations, values[some] / (centred**2).mean(axis=0).sum()


def check(result, rows, tolerance=1e-8):
    ids, white, deviations, explained = brute(rows)
    size = white.shape[1]
    assert len(result) == len(ids) * size
    result.sort(key=lambda r: (r[0], r[1]))
    got = np.array([r[4] for r in result]).reshape(len(ids), size)
    order = np.argsort(ids)
    signs = np.sign((got * white[order]).sum(axis=0))
    assert np.abs(got * signs - white[order]).max() < tolerance
    assert [r[0] for r in result] == [i for i in sorted(ids) for _ in range(size)]
    assert [r[1] for r in result] == [*range(1, size + 1)] * len(ids)
    assert [r[3] for r in result[::size]] == [deviations[k] for k in order]
    assert np.allclose([r[5] for r in result[:size]], explained, rtol=1e-9)
    assert {r[2] for r in result} == {len(ids)} and len({r[6] for r in result}) == 1
    assert result[0][6] < 1e-9


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    return make


def test_whole_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    check(rows_of(whitening.op12(frame)), [(r.vec_id, r.embedding) for r in frame.collect()])


def test_a_third_of_all_rows_is_one_vector(table):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=7).tolist()) for i in range(80)] + [(i, [0.5] * 7) for i in range(80, 130)]
    check(rows_of(whitening.op12(table(rows).repartition(9))), rows)


def test_rows_that_take_no_part(table):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(30)]
    bad = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [math.nan] * 4), (53, [math.inf, 0.0, 0.0, 0.0]), (54, []), (55, [1e300] * 4)]
    result = rows_of(whitening.op12(table(rows + bad)))
    assert {r[0] for r in result} == set(range(30))
    check(result, rows)


def test_equal_vectors_have_no_components_and_few_vectors_have_few(table):
    assert rows_of(whitening.op12(table([(1, [1.0, 2.0]), (2, [1.0, 2.0])]))) == []
    assert rows_of(whitening.op12(table([(1, [1.0, 2.0])]))) == []
    assert rows_of(whitening.op12(table([]))) == []
    rows = [(1, [1.0, 2.0, 5.0]), (2, [3.0, 2.5, 0.0])]
    check(rows_of(whitening.op12(table(rows))), rows)


def test_repeated_and_missing_ids_count(table):
    rows = [(1, [0.1, 0.9]), (1, [0.4, 0.2]), (1, [0.4, 0.2]), (None, [0.7, 0.1])]
    result = rows_of(whitening.op12(table(rows)))
    assert sorted((r[0] or 0, r[1], r[2]) for r in result) == [(0, 1, 4), (0, 2, 4)] + [(1, 1, 4)] * 3 + [(1, 2, 4)] * 3


def test_lengths_are_whitened_apart(table):
    draw = np.random.default_rng(3)
    two, three = ([(k * 100 + i, draw.normal(size=k).tolist()) for i in range(20)] for k in (2, 3))
    result = rows_of(whitening.op12(table(two + three)))
    check([r for r in result if r[0] < 300], two)
    check([r for r in result if r[0] >= 300], three)


def test_large_entries_stay_exact(table):
    rows = [(i, [(-1.0) ** i * 1.5e6 + i, i * 1e5]) for i in range(12)]
    check(rows_of(whitening.op12(table(rows))), rows, 1e-6)
    huge = rows_of(whitening.op12(table([(1, [1e15, 0.0]), (2, [-1e15, 1.0])])))
    assert [r[3] for r in huge] == [None, None]


def test_more_components_than_asked_for_are_left_out(table):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(40)]
    result = rows_of(whitening.whiten(table(rows), components=2))
    assert {r[1] for r in result} == {1, 2}


def test_clashing_columns_are_ignored(table):
    rows = [(1, [0.1, 0.9]), (2, [0.4, 0.2]), (3, [0.3, 0.3])]
    frame = table(rows)
    for name in ("component", "n", "length", "i", "total", "whitened"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    check(rows_of(whitening.op12(frame)), rows)


def spectra():
    draw = np.random.default_rng(5)
    turn, _ = np.linalg.qr(draw.normal(size=(40, 40)))
    rows = draw.normal(size=(10, 40))
    line = np.diag(np.ones(39), 1)
    for values in (
        np.arange(40.0), np.r_[[5.0] * 10, [3.0] * 10, np.linspace(0, 1, 20)], 10.0 ** -np.arange(40.0),
        np.r_[5 + 1e-9 * np.arange(10), 3 + 1e-12 * np.arange(10), np.linspace(0, 1, 20)], np.ones(40), np.zeros(40),
    ):
        yield turn @ np.diag(values) @ turn.T
        yield np.diag(values)
    yield from (rows.T @ rows, line + line.T, np.ones((40, 40)), np.diag(np.abs(np.arange(40) - 20.0)) + line + line.T)


@pytest.mark.parametrize("matrix", list(spectra()))
def test_slicing_finds_hard_spectra(matrix):
    values, vectors = spectrum.leading(matrix, 32)
    largest = max(1e-300, np.abs(matrix).max())
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:32]).max() <= 1e-11 * largest
    assert np.abs(vectors @ vectors.T - np.eye(32)).max() < 1e-9
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-11 * largest


@pytest.mark.parametrize("size", [1, 2, 9, 30])
def test_inertia_counts(size):
    draw = np.random.default_rng(size)
    for _ in range(40):
        matrix = draw.normal(size=(size, size)) * (draw.random((size, size)) < 0.5)
        matrix = matrix + matrix.T
        shift = draw.normal()
        assert spectrum.count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()
