"""Periodic runs against a brute-force search of every period."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_reading import SF, crc, rows_of, words_of

from pacefold.llm import periodic_runs


def brute_runs(words, least=6, repeats=4):
    """Every period from the smallest: maximal stretches of words that recur a period on."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    w = np.array([numbers[x] for x in words])
    found = []
    for q in range(1, len(w) // repeats + 1):
        same = np.concatenate([[0], w[:-q] == w[q:], [0]]).astype(int)
        for low, high in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            length = high - low + q
            whole = w[low : low + length]
            if length < max(least, repeats * q):
                continue
            if not any((whole[:-r] == whole[r:]).all() for r in range(1, q)):
                found.append((int(low), int(length), q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = words_of(text)
    if doc_id is None or crc(doc_id) % 10 or not words:
        return words
    n, g = len(words), crc(doc_id) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(rows):
    out = []
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = brute_runs(words)
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        out.append((doc_id, len(runs), *best, digest(lines), digest(brute_collapsed(words, runs))))
    return sorted(out, key=str)


def found(frame):
    return sorted(rows_of(periodic_runs.op11(frame)), key=str)


def test_whole_table_against_brute_force(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    expected = brute(rows)
    assert sum(row[1] > 0 for row in expected) > 5
    assert found(frame) == expected


def random_words(pick):
    """Words of a small alphabet with stretches of periods, nested and overlapping."""
    words = []
    for _ in range(pick.randrange(1, 9)):
        unit = [pick.choice("abc") for _ in range(pick.randrange(1, 7))]
        if pick.random() < 0.3:
            unit = unit * 5 + [pick.choice("abcd")]
        words += unit * pick.randrange(1, 9) + unit[: pick.randrange(len(unit))]
    return words


@pytest.mark.parametrize("least, repeats", [(6, 4), (2, 2), (5, 3), (12, 2), (1, 6)])
def test_runs_of_random_words(least, repeats):
    pick = random.Random(least * 10 + repeats)
    texts = [random_words(pick) for _ in range(150)] + [[], ["a"], ["a"] * 300, list("ab") * 100]
    docs = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    numbers = np.array(["abcd".index(w) for t in texts for w in t], dtype=np.int64)
    start, length, period = periodic_runs.runs_of(numbers, docs, least, repeats)
    firsts = np.cumsum([0, *map(len, texts)])
    for doc, words in enumerate(texts):
        own = np.flatnonzero(docs[start] == doc)
        got = [(int(start[k] - firsts[doc]), int(length[k]), int(period[k])) for k in own]
        assert got == brute_runs(words, least, repeats)


def test_fibonacci_and_thue_morse_words():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    for word in (b, morse, morse[:511] + morse[:511] * 4):
        numbers = np.array(["ab".index(c) for c in word], dtype=np.int64)
        got = periodic_runs.runs_of(numbers, np.zeros(len(word), dtype=np.int64), 2, 2)
        assert list(zip(*(c.tolist() for c in got), strict=True)) == brute_runs(list(word), 2, 2)


def ids_with(remainder, count):
    return [i for i in range(10_000) if (crc(i) % 10 == 0) == remainder][:count]


def test_edges(docs):
    plain, rewritten = ids_with(False, 9), ids_with(True, 6)
    texts = [None, "", " \t\n ", "one", "a a a a a a", "a a a a a", "  A a\x0ba\x0ca a a a  b ", "x " * 3000, "p q r " * 4]
    rows = [*zip(plain, texts, strict=True), *zip(rewritten, [None, "", "one", "a b c d e f g h", " ".join(map(str, range(500))), "z z z z z z z"], strict=True)]
    assert found(docs(rows)) == brute(rows)
    assert found(docs([])) == []


def test_repeated_and_missing_ids_are_documents_of_their_own(docs):
    rows = [(1, "a a a a a a a"), (1, "a a a a a a a"), (1, "b c"), (None, "a b " * 6), (None, None)]
    assert found(docs(rows)) == brute(rows)


def test_long_text(docs):
    pick = random.Random(2)
    middle = [pick.choice("abcdefghij") for _ in range(700)]
    words = [str(pick.randrange(10**6)) for _ in range(150_000)] + middle * 5 + ["x"] * 20_000
    doc_id = ids_with(False, 1)[0]
    out = periodic_runs.periodic_runs(docs([(doc_id, " ".join(words))])).first()
    assert [tuple(r) for r in out.runs if r.period in (700, 1)][-2:] == [(150_000, 3500, 700), (153_500, 20_000, 1)]
    assert out.n_words == len(words)


def test_operator_returns_runs_and_text(docs):
    row = periodic_runs.periodic_runs(docs([(7, "see  a b a b a b a b\tnow")])).first()
    assert (row.doc_id, row.n_words, row.collapsed) == (7, 10, "see a b now")
    assert [tuple(r) for r in row.runs] == [(1, 8, 2)]


def test_clashing_columns_are_ignored(docs):
    frame = docs([(1, "a a a a a a b")])
    for name in ("start", "period", "runs", "_h", "_words", "_a", "_p"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    assert found(frame) == brute([(1, "a a a a a a b")])
