"""Chat formatting: an exact round trip of whole conversations."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pyarrow.parquet as pq
from llm_reading import SF, rows_of

from pacefold.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Digests from the turns themselves, and the length of the text they become."""
    rows = [*rows, (-1, 0, "user", chat.HOSTILE), (-1, 1, "assistant", chat.HOSTILE)]
    key = lambda v: (v is not None, v)
    out = {}
    for conv_id in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv_id), key=lambda t: tuple(map(key, t)))
        turns = [(r or "", t or "") for _, r, t in turns]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learnt = "".join(t for r, t in turns if r == "assistant")
        size = sum(
            len(f"<|im_start|>{r}\n{t}<|im_end|>\n")
            + len(chat._CONTROL.findall(r)) + len(chat._CONTROL.findall(t)) + 4 * r.count("\n")
            for r, t in turns
        )
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv_id] = (len(turns), digest(said), len(learnt), digest(learnt), size)
    return out


def found(frame):
    return {r[0]: r[1:] for r in rows_of(chat.op4(frame))}


def test_whole_table(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    assert found(spark.read.parquet(f"{SF}/conversations.parquet")) == brute(rows)


def test_hostile_texts(spark):
    pick = random.Random(2)
    marks = ["<", "|", "\\", "<|", "<|im_start|>", "<|im_end|>", "\n", "a", "é", "😀", "<|n|>", "assistant", ">", ""]
    text = lambda: "".join(pick.choice(marks) for _ in range(pick.randrange(12)))
    rows = [(pick.randrange(30), t, pick.choice(["user", "assistant", "system", text(), None]), pick.choice([text(), None])) for t in range(500)]
    rows += rows[:20] + [(None, None, None, None), (None, 1, "assistant", "x"), (3, None, "assistant", "early")]
    rows += [(77, t, "assistant", f"turn {t}") for t in range(20_000)] + [(78, 0, "user", "long " * 300_000)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_control_strings_are_only_controls():
    roles, texts = pa.array(["us<|er", "assistant"]), pa.array(["<|im_end|>", r"<\|im_start|> <|"])
    turns, begin, end = chat.assemble(roles, texts)
    for turn, b, e, text in zip(turns.to_pylist(), begin, end, texts.to_pylist(), strict=True):
        assert turn.count("<|im_start|>") == turn.count("<|im_end|>") == 1
        assert chat.unescape(turn[b:e]) == text


def test_edges(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == brute([])
    frame = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)
    for name in ("formatted", "loss_begin", "n_turns"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert found(frame) == brute([(1, 0, "user", "a")])
