"""Token counts against the tokenizer's library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from llm_reading import SF, rows_of

from pacefold.llm import postings, token_counts


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path(token_counts.TOKENIZER)
    return sentencepiece.SentencePieceProcessor(model_file=path)


def brute(library, rows):
    out = []
    for doc_id, text in rows:
        n = len(library.encode(text or ""))
        out.append((doc_id, len((text or "").encode()), n, n > 4096))
    return sorted(out, key=str)


def found(frame):
    return sorted(rows_of(token_counts.op3(frame)), key=str)


def test_no_piece_crosses_a_pre_token(library):
    """What the cutting rests on: spaces lead a piece, line feeds are in none."""
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert not [n for n in names if "▁" in n.lstrip("▁") or "\n" in n]


@pytest.mark.parametrize("batch_tokens", [1_000_000, 3_000])
def test_whole_table(spark, library, monkeypatch, batch_tokens):
    monkeypatch.setattr(postings, "BATCH_TOKENS", batch_tokens)
    rows = [
        (r["doc_id"], r["text"])
        for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    ]
    assert found(spark.read.parquet(f"{SF}/documents.parquet")) == brute(library, rows)


def test_odd_texts(docs, library):
    pick = random.Random(5)
    marks = [" ", "  ", "\n", "\t", "\r\n", "▁", "a", "the", "é", "漢", "😀", "<s>", "</s>", "<unk>", " ", "\x00", ".", "<0x0A>"]
    rows = [(i, "".join(pick.choice(marks) for _ in range(pick.randrange(30)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, " "), (503, "   "), (504, "\n"), (505, "x" * 30_000), (506, " ▁ ▁▁  a"), (507, "word " * 6000)]
    assert found(docs(rows)) == brute(library, rows)


def test_edges(docs, library):
    assert found(docs([])) == []
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "a b c"), (None, "d")]
    assert found(docs(rows)) == brute(library, rows)
    frame = docs([(1, "p q")]).selectExpr("*", "'x' AS part", "'x' AS batch", "'x' AS n_tokens")
    assert found(frame) == brute(library, [(1, "p q")])
