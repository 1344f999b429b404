"""The network's gradients and state, the base against plain counting, and learning."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
import pyarrow.parquet as pq
from llm_reading import crc, lower_ascii, rows_of, words_of

from pacefold.llm import gru, language_model, postings

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Base score, token counts and N of every row, from plain counts."""
    split = [(i, [*words_of(lower_ascii(t)), None]) for i, t in rows]
    counts = Counter(w for i, ws in split if crc("" if i is None else i) % 7 != 2 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return sorted(
        (
            (
                i, crc("" if i is None else i) % 7 == 2, len(ws), sum(w in counts for w in ws), total,
                sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws),
            )
            for i, ws in split
        ),
        key=str,
    )


def same(result, expected):
    result = sorted(result, key=str)
    assert [r[:5] for r in result] == [e[:5] for e in expected]
    assert np.allclose([r[5] for r in result], [e[5] for e in expected])


def test_whole_table(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    result = rows_of(language_model.op2(spark.read.parquet(f"{SF}/documents.parquet")))
    same(result, brute([(r["doc_id"], r["text"]) for r in table]))
    held = [r for r in result if r[1]]
    # the network does better than counts on texts it has not seen
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
    assert all(r[6] < 0 for r in result)


def network(size=40):
    frequency = np.sort(np.random.default_rng(1).integers(0, 500, size))[::-1]
    return gru.new_network(frequency.astype(float))


def test_probabilities_sum_to_one():
    net = network()
    pick = np.random.default_rng(2)
    for state in pick.normal(size=(3, gru.STATE)).astype(np.float32):
        states = np.repeat(state[None], 40, axis=0)
        logs = gru.log_probabilities(net, states, np.arange(40))
        assert np.isclose(np.exp(logs).sum(), 1, atol=1e-5)


def test_a_text_and_what_is_unknown_sum_to_one(spark, docs):
    """Known tokens, unknown seen ones and one never seen make up all probability."""
    rows = [(i, f"a b c{i % 5} d{i}") for i in range(40)]
    training = docs(rows).selectExpr("doc_id", "text")
    known = language_model.learn_vocabulary(training)
    counts = np.array([])  # all seen tokens are in the vocabulary here
    assert len(known.hashes) == known.distinct and known.unknown_room == 1.0
    share = (counts + 1).sum() / known.unknown_room + 1 / known.unknown_room
    assert np.isclose(share, 1)


def test_gradients(monkeypatch):
    net = network(12)
    net.parameters = {n: v.astype(np.float64) for n, v in net.parameters.items()}
    pick = np.random.default_rng(3)
    words = pick.integers(0, 12, (5, 3))
    ends = pick.random((5, 3)) < 0.2
    state = pick.normal(size=(3, gru.STATE)) * 0.3
    _, found, _ = gru.gradients(net, words, ends, state.copy())
    for name, value in net.parameters.items():
        for _ in range(6):
            at = tuple(pick.integers(0, s) for s in value.shape)
            losses = []
            for change in (1e-5, -2e-5):
                value[at] += change
                losses.append(gru.gradients(net, words, ends, state.copy())[0])
            value[at] += 1e-5
            assert np.isclose(found[name][at], (losses[0] - losses[1]) / 2e-5, rtol=1e-3, atol=1e-7), name


def plain_step(net, state, word):
    """The state behind a word, by the formulas of the module's docstring."""
    p = net.parameters
    x = p["embedding"][word] @ p["input"] + p["bias"]
    (x_z, x_r, x_n), (u_z, u_r, u_n) = np.split(x, 3), np.split(p["state"], 3, axis=1)
    z, r = (1 / (1 + np.exp(-(x + state @ u))) for x, u in ((x_z, u_z), (x_r, u_r)))
    return (1 - z) * np.tanh(x_n + r * (state @ u_n)) + z * state


def test_score_is_that_of_whole_documents():
    """Windows change nothing: one document at a time, one step at a time."""
    net = network()
    pick = np.random.default_rng(4)
    sizes = [1, 3, 200, 33, 32, 1]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pick.integers(0, 40, offsets[-1])
    found = gru.score(net, words, offsets)
    for row in range(len(sizes)):
        state, total = np.zeros(gru.STATE), 0.0
        for word in words[offsets[row] : offsets[row + 1]]:
            total += gru.log_probabilities(net, state[None].astype(np.float32), np.array([word]))[0]
            state = plain_step(net, state, word)
        assert np.isclose(found[row], total, rtol=1e-4)


def test_training_learns_an_order():
    pick = np.random.default_rng(5)
    pairs = np.stack([n := pick.integers(1, 15, 6000), n + 15], 1).reshape(-1)  # b follows a
    frequency = np.bincount(pairs, minlength=40).astype(float)
    net, offsets = gru.new_network(frequency), np.arange(0, len(pairs) + 1, 100)
    before = gru.score(net, pairs, offsets).sum()
    for _ in range(3):
        net = gru.train(net, pairs, offsets, 0.02)
    assert gru.score(net, pairs, offsets).sum() > 0.75 * before


def test_edges(spark, docs, monkeypatch):
    monkeypatch.setattr(postings, "BATCH_TOKENS", 50)
    monkeypatch.setattr(language_model, "SCORED_TOKENS", 50)
    rows = [(1, None), (2, ""), (3, "One two"), (3, "One two"), (4, "one\tTWO\x0bé É"), (None, "x y"), (5, "w v " * 20_000)]
    rows += [(i, f"text {i} of several words") for i in range(10, 60)]
    frame = docs(rows).selectExpr("*", "'x' AS part", "'x' AS shard", "1 AS score")
    same(rows_of(language_model.op2(frame)), brute(rows))
    assert rows_of(language_model.op2(docs([]))) == []
    lone = next(i for i in range(100) if crc(i) % 7 == 2)
    ((*_, base, score),) = rows_of(language_model.op2(docs([(lone, "nothing learnt")])))
    assert base == 0 and abs(score) < 1e-6


def test_every_training_document_moves_the_weights(docs):
    """However large the corpus: words of a single document have moved, all of them."""
    rows = [(i if i % 3 else None, f"a own{i} b c") for i in range(120)]
    training = docs(rows).select("doc_id", "text")
    known = language_model.learn_vocabulary(training)
    net = language_model.learn_network(training, replace(known, total=10**9))
    change = net.parameters["embedding"] - gru.new_network(known.frequency).parameters["embedding"]
    words = known.ids[known.hashes != language_model.END]  # behind an end, the state is new
    assert len(words) == 123 and (np.abs(change[words]).sum(axis=1) > 0).all()


def test_lookup_where_hashes_share_their_first_bits():
    pick = np.random.default_rng(6)
    close = (np.uint64(7) << np.uint64(60)) + np.arange(5, dtype=np.uint64)
    hashes = np.unique(np.concatenate([close, pick.integers(0, 2**63, 300).astype(np.uint64), np.array([0, 2**64 - 1], dtype=np.uint64)]))
    ids, logs = pick.permutation(len(hashes)), pick.random(len(hashes))
    known = language_model.Vocabulary(hashes, ids, logs, 999, np.ones(2), 1, 1)
    asked = np.concatenate([hashes, close + np.uint64(5), pick.integers(0, 2**63, 500).astype(np.uint64)])
    want = {int(h): (int(i), float(x)) for h, i, x in zip(hashes, ids, logs, strict=True)}
    numbers, found = known.lookup(asked)
    assert list(zip(numbers.tolist(), found.tolist(), strict=True)) == [want.get(int(h), (999, 0.0)) for h in asked]
    nothing = language_model.Vocabulary(hashes[:0], ids[:0], logs[:0], 0, np.ones(1), 0, 0)
    assert (nothing.lookup(asked)[0] == 0).all()


def test_shards_hold_every_token_once(docs, monkeypatch):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 50)
    training = docs([(None, f"a b c{i}") for i in range(100)]).select("doc_id", "text")
    known = language_model.learn_vocabulary(training)
    rows = rows_of(language_model.shards(training, known))
    words = np.concatenate([postings.unpack(w) for _, w, _ in rows])
    assert (np.bincount(words, minlength=len(known.frequency)) == known.frequency).all()
    assert sum(postings.unpack(s).astype(int).sum() for _, _, s in rows) == known.total
    assert {r for r, _, _ in rows} == set(range(language_model.ROUNDS))


def some_text(size, seed=1):
    pick = np.random.default_rng(seed)
    words = pick.integers(0, 40, size)
    offsets = np.unique(np.concatenate([[0], pick.integers(1, size, size // 30), [size]]))
    return words, offsets


@pytest.mark.parametrize("size", [1, 31, 1919, 1921, 3901, 6007])
def test_streams_hold_every_token_once(size):
    words, offsets = some_text(size)
    laid, ends, real = gru.in_streams(words, offsets)
    assert (laid.T[real.T] == words).all()
    assert (np.flatnonzero(ends.T[real.T]) == offsets[1:] - 1).all() and not ends[~real].any()


@pytest.mark.parametrize("back", [1, 2, 40])
def test_the_last_tokens_of_a_shard_teach(back):
    words, offsets = some_text(6007)
    net = gru.new_network(np.arange(41, 0, -1))
    other = words.copy()
    other[-back] = 40
    first, second = (gru.flatten(gru.train(net, w, offsets, 0.01)) for w in (words, other))
    assert np.abs(first - second).max() > 1e-6


def test_filled_places_count_for_nothing():
    words, _ = some_text(20)
    net = gru.new_network(np.arange(41, 0, -1))
    plain = words[:, None], np.zeros((20, 1), dtype=bool)
    state = np.zeros((1, gru.STATE), dtype=np.float32)
    loss, found, _ = gru.gradients(net, *plain, state)
    padded = [np.pad(part, ((0, 12), (0, 0))) for part in (*plain, np.ones((20, 1), dtype=bool))]
    same_loss, same, _ = gru.gradients(net, *padded[:2], state, padded[2])
    assert abs(loss - same_loss) < 1e-5
    for name, values in found.items():
        assert np.abs(values - same[name]).max() < 1e-6, name


def test_weights_are_the_same_in_every_run(docs):
    frame = docs([(i, f"a own{i % 7} b c d{i % 3}") for i in range(200)]).repartition(5).select("doc_id", "text")
    known = language_model.learn_vocabulary(frame)
    runs = [gru.flatten(language_model.learn_network(frame, known)) for _ in range(2)]
    assert (runs[0] == runs[1]).all()
