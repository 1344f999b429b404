"""Looking up a value per distinct token and adding it up per document.

The corpus is cut into batches of documents. A batch asks for the value of each of its
distinct tokens once, however often and in however many documents it occurs, and keeps
which documents have it how often. Requests are grouped by token, so a value can depend
on the whole corpus; the answers go back to the batch, whose documents add them up.

No group grows with a token's frequency: a token that is in every document is asked for
once per batch. A batch is bounded, and so is the group it forms.

Batches are numbered by the task that reads them and their order in it, which a task
that is run again repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pacefold.llm.folders import partitions

#: Tokens and documents of a batch, about; a longer document is a batch of its own.
BATCH_TOKENS = 1_000_000
BATCH_DOCS = 50_000
#: Groups of tokens per shuffle partition.
SPREAD = 2

_REQUEST, _POSTINGS = 0, 1
SCHEMA = "part int, kind int, batch long, keys binary, notes binary, docs binary, counts binary, info binary"
_COLUMNS = ["part", "kind", "batch", "keys", "notes", "docs", "counts", "info"]
_ANSWER = "batch long, part int, answers binary, sizes binary, docs binary, counts binary, info binary"


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes: the type's name, then as few bytes a number as will do."""
    if values.dtype.kind in "iu":
        values = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    return values.dtype.str.encode().ljust(4) + values.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.dtype(bytes(blob[:4]).decode().strip()), offset=4)


@dataclass
class Batch:
    """Distinct tokens of some documents, and where they occur."""

    hashes: np.ndarray  # of each distinct token, ascending
    first: np.ndarray  # one occurrence of it among the tokens given
    sizes: np.ndarray  # number of documents that have it
    docs: np.ndarray  # those documents, token by token
    counts: np.ndarray  # how often each has it


def count(hashes: np.ndarray, docs: np.ndarray) -> Batch:
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    width = int(docs.max()) + 1 if len(docs) else 1
    pairs, counts = np.unique(place * width + docs, return_counts=True)
    sizes = np.bincount(pairs // width, minlength=len(distinct))
    return Batch(distinct, first, sizes, pairs % width, counts)


def messages(
    number: int, batch: Batch, info: pa.RecordBatch, parts: int, ask: Callable
) -> Iterator[pa.RecordBatch]:
    """The requests of a batch, one per part, and its postings in the same order.

    ``ask(rows)`` gives the two columns of a request for the tokens ``rows``.
    """
    part = (batch.hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ends = np.concatenate([[0], np.cumsum(batch.sizes)])
    sizes = batch.sizes[order]
    take = np.arange(sizes.sum()) + np.repeat(ends[order] - (np.cumsum(sizes) - sizes), sizes)
    rows = [
        (number % parts, _POSTINGS, number, None, pack(sizes), pack(batch.docs[take]), pack(batch.counts[take]), _sent(info))
    ]
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1)) if len(order) else order
    for chosen in np.split(order, cuts[1:]) if len(order) else ():
        keys, notes = ask(chosen)
        rows.append((int(part[chosen[0]]), _REQUEST, number, keys, notes, None, None, None))
    types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], _COLUMNS
    )


def _sent(info: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, info.schema) as writer:
        writer.write_batch(info)
    return sink.getvalue().to_pybytes()


def received(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def batch_number(sequence: int) -> int:
    return (TaskContext.get().partitionId() << 24) + sequence


def answered(sent: DataFrame, answer: Callable[[list, list], list[np.ndarray]]) -> DataFrame:
    """One row per request with its answers, and one per batch with its postings.

    ``answer(keys, notes)`` is given the columns of all requests of a part and returns
    one array of values per request.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        asked = [i for i, kind in enumerate(rows["kind"]) if kind == _REQUEST]
        values = answer([rows["keys"][i] for i in asked], [rows["notes"][i] for i in asked])
        out = [
            (rows["batch"][i], rows["part"][i], pack(v), None, None, None, None)
            for i, v in zip(asked, values, strict=True)
        ]
        out += [
            (rows["batch"][i], -1, None, rows["notes"][i], rows["docs"][i], rows["counts"][i], rows["info"][i])
            for i, kind in enumerate(rows["kind"])
            if kind == _POSTINGS
        ]
        return pa.table(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _answer_types(), strict=True)],
            names=_answer_names(),
        )

    return sent.groupBy("part").applyInArrow(run, _ANSWER)


def _answer_names() -> list[str]:
    return [field.split()[0] for field in _ANSWER.split(", ")]


def _answer_types() -> list[pa.DataType]:
    return [pa.int64(), pa.int32(), *[pa.binary()] * 5]


def per_batch(
    answers: DataFrame, finish: Callable[[pa.RecordBatch, np.ndarray, Callable], pa.Table], schema: str
) -> DataFrame:
    """Add the answers up in each batch.

    ``finish(info, values, total)`` is given the batch's documents, the value of each of
    its distinct tokens and ``total(values)``, which adds up values over each document's
    tokens, and returns the rows of the result.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pydict()
        info = received(rows["info"][0])
        sizes, docs, counts = (unpack(rows[c][0]) for c in ("sizes", "docs", "counts"))
        blobs = [unpack(a) for a in rows["answers"][1:]]
        values = np.concatenate(blobs) if blobs else np.zeros(0)

        def total(each: np.ndarray) -> np.ndarray:
            weights = np.repeat(each.astype(np.float64), sizes) * counts
            return np.bincount(docs, weights, minlength=info.num_rows)

        return finish(info, values, total)

    return answers.groupBy("batch").applyInArrow(run, schema)


def send(documents: DataFrame, reader: Callable) -> DataFrame:
    """Requests and postings of all documents; ``reader(parts)`` maps Arrow batches."""
    return documents.mapInArrow(reader(SPREAD * partitions(documents.sparkSession)), SCHEMA)

