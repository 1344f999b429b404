"""Token counts of documents without tokenising any document.

The tokenizer's merges never cross certain places, so a text falls into pre-tokens whose
pieces can be counted on their own. The pieces of each distinct pre-token are counted
once, and a document's count is the sum over its pre-tokens of how often it has them
times their pieces. No ids of a document are ever made.

For this tokenizer (white space escaped, no normalisation, no piece with a space mark
behind another character, none with a line feed) a pre-token begins at each run of
spaces and at each line feed, and where the text begins, which the library marks with a
space of its own. A literal space mark counts as a space to the library, so a space
right behind one begins nothing.

Defined cases: null and empty texts have no tokens; rows that repeat a ``doc_id`` get a
row each; documents without an id too; further columns are ignored; an empty table
gives an empty result. A long text without spaces is one pre-token.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.llm import postings
from pacefold.llm.text import Piece, owners, pieces, prefix_sums, span_hashes

TOKENIZER = "piece_bpe_32k.model"
#: Documents above this many tokens are marked.
LIMIT = 4096

_SPACE, _FEED = 0x20, 0x0A
#: A mark the library puts in place of spaces, as bytes.
_MARK = "▁".encode()
_AT_ONCE = 20_000


def pre_tokens(piece: Piece) -> tuple[Piece, np.ndarray]:
    """The piece with a space before each non-empty text, and where pre-tokens begin."""
    full = np.diff(piece.offsets) > 0
    data = np.insert(piece.data, piece.offsets[:-1][full], _SPACE)
    offsets = piece.offsets + np.concatenate([[0], np.cumsum(full)])
    space = data == _SPACE
    joined = np.zeros(len(data), dtype=bool)
    joined[1:] = space[:-1]
    marked = (data[:-3] == _MARK[0]) & (data[1:-2] == _MARK[1]) & (data[2:-1] == _MARK[2])
    joined[3:] |= marked
    begins = (space & ~joined) | (data == _FEED)
    begins[offsets[:-1][full]] = True
    return Piece(piece.first, piece.last, data, offsets), np.flatnonzero(begins)


def piece_counts(processor: sentencepiece.SentencePieceProcessor, tokens: list[str]) -> np.ndarray:
    """Pieces of each pre-token.

    Behind a line feed the library adds nothing to a text, so it is put before each and
    its two pieces (the text's own space mark, the line feed) are taken off.
    """
    counts = []
    for low in range(0, len(tokens), _AT_ONCE):
        encoded = processor.encode(["\n" + t for t in tokens[low : low + _AT_ONCE]], num_threads=1)
        counts += [len(ids) - 2 for ids in encoded]
    return np.array(counts, dtype=np.int64)


def _read(parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, held, tokens, docs = 0, [], 0, 0
        for batch in batches:
            ids = batch.column("doc_id")
            for piece in pieces(batch.column("text")):
                spaced, starts = pre_tokens(piece)
                held.append((spaced, starts, ids.slice(piece.first, piece.count), np.diff(piece.offsets)))
                tokens, docs = tokens + len(starts), docs + piece.count
                if tokens >= postings.BATCH_TOKENS or docs >= postings.BATCH_DOCS:
                    yield from _flush(held, sequence, parts)
                    sequence, held, tokens, docs = sequence + 1, [], 0, 0
        if held:
            yield from _flush(held, sequence, parts)

    return run


def _flush(held: list, sequence: int, parts: int) -> Iterator[pa.RecordBatch]:
    hashes, docs, begins, ends, base, first_doc = [], [], [], [], 0, 0
    for spaced, starts, _, _ in held:
        stops = np.append(starts[1:], len(spaced.data))[: len(starts)]
        hashes.append(span_hashes(prefix_sums(spaced.data), starts, stops))
        docs.append(owners(spaced, starts) + first_doc)
        begins.append(starts + base)
        ends.append(stops + base)
        base, first_doc = base + len(spaced.data), first_doc + spaced.count
    data = np.concatenate([spaced.data for spaced, _, _, _ in held])
    begin, end = np.concatenate(begins), np.concatenate(ends)
    batch = postings.count(np.concatenate(hashes), np.concatenate(docs))
    info = pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([ids for _, _, ids, _ in held]).cast(pa.int64()),
            pa.array(np.concatenate([sizes for _, _, _, sizes in held])),
        ],
        ["doc_id", "n_bytes"],
    )

    def ask(rows: np.ndarray) -> tuple[bytes, bytes]:
        at = batch.first[rows]
        lengths = end[at] - begin[at]
        take = np.arange(lengths.sum()) + np.repeat(
            begin[at] - (np.cumsum(lengths) - lengths), lengths
        )
        return postings.pack(lengths), data[take].tobytes()

    yield from postings.messages(postings.batch_number(sequence), batch, info, parts, ask)


def _count_once(model: bytes) -> Callable:
    """Answer requests: the pieces of each distinct pre-token, counted once."""

    def answer(keys: list[bytes], notes: list[bytes]) -> list[np.ndarray]:
        if not keys:
            return []
        lengths = [postings.unpack(k).astype(np.int64) for k in keys]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        strings = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1,
            [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(notes))],
        )
        encoded = pc.dictionary_encode(strings)
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        tokens = [t.decode("utf-8", "replace") for t in encoded.dictionary.to_pylist()]
        values = piece_counts(processor, tokens)[encoded.indices.to_numpy()]
        return np.split(values, np.cumsum([len(n) for n in lengths])[:-1])

    return answer


def _sum_up(limit: int) -> Callable:
    def finish(info: pa.RecordBatch, values: np.ndarray, total: Callable) -> pa.Table:
        tokens = total(values).astype(np.int64)
        return pa.table(
            [info.column("doc_id"), info.column("n_bytes"), pa.array(tokens), pa.array(tokens > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return finish


def token_counts(documents: DataFrame, model: bytes, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document for a tokenizer's model."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    answers = postings.answered(postings.send(texts, _read), _count_once(model))
    return postings.per_batch(
        answers, _sum_up(limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def read_model(path: str) -> bytes:
    """A tokenizer file on the driver; its half megabyte travels with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def op3(documents: DataFrame) -> DataFrame:
    return token_counts(documents, read_model(public_tokenizers.path(TOKENIZER)))
