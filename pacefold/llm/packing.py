"""Packing documents into sequences: first-fit decreasing on a tournament tree.

A document's ids are cut into pieces of a whole sequence and one remainder. Documents
are dealt at random into groups of about ``GROUP_DOCS``, and every group is packed on its
own: its remainders go, longest first, each into the first bin that still has room for
it. A tournament tree over the bins' free room, every node holding the larger of its two
children, finds that bin in as many steps as the tree is high.

What then is left free is little, and is filled by cutting: the emptiest bins are taken
apart and their ids fill the others, until all bins but one have at most ``SLACK`` ids of
room. The last is cut into sequences whose lengths are powers of two, which need no
padding. No id is lost, repeated or moved within its document.

The tokenizer drops white space and splits at it, and between letters, digits and other
characters, so a text's ids are those of such chunks in turn. A worker asks the library
once for each distinct chunk, remembers up to ``REMEMBERED`` of them, and gathers the ids
of its documents in numpy; no text is tokenised as a whole.

Defined cases: null and empty texts have the end id alone; rows that repeat an id, or have
none, are documents of their own; a text of any length is cut into pieces by the task
that reads it, which needs some 100 bytes for each of its bytes; further columns are
ignored; an empty table gives an empty result. Groups follow the order in which a task
reads its rows, so another layout of the input gives another, equally valid, packing.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.llm.text import IS_SPACE, Piece, mix, owners, pieces

TOKENIZER = "word_bpe_49k.json"
#: The id that ends each document.
END_ID = 2
#: Most ids of a sequence.
LIMIT = 4096
#: Ids a sequence may lack before others are cut to fill it.
SLACK = 8
#: Documents of a group, about.
GROUP_DOCS = 4096
#: Distinct chunks whose ids a worker remembers.
REMEMBERED = 600_000
#: Bytes of text whose chunks are looked up at a time.
PIECE_BYTES = 1 << 22

#: What the model's tokens that end a word end with.
_WORD_END = "</w>"
_AT_ONCE = 2_000
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[IS_SPACE] = _SPACE
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
#: Apostrophe, and first bytes of what is no letter from U+00C0 to U+027F.
_ODD = np.zeros(256, dtype=bool)
_ODD[[0x27, 0xC2, *range(0xCA, 0x100)]] = True

_PIECE = "group long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
_PIECE_COLUMNS = [field.split()[0] for field in _PIECE.split(", ")]
RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class ChunkIds:
    """Ids of chunks, each distinct one asked of the library once while remembered."""

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(model)
        vocabulary = self._library.get_vocab(with_added_tokens=True)
        size = max(END_ID, *vocabulary.values()) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self._ends = np.zeros(size, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._known: dict[bytes, int] = {}
        self._flat, self._sizes = np.zeros(0, dtype=self.dtype), np.zeros(0, dtype=np.int64)

    def of(self, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids end to end, and where those of each chunk begin and how many they are."""
        get = self._known.get
        index = np.fromiter((get(c, -1) for c in distinct), dtype=np.int64, count=len(distinct))
        new = np.flatnonzero(index < 0)
        flat, sizes = self._flat, self._sizes
        if len(new):
            chunks = [distinct[i] for i in new]
            more, counts = self._encode([c.decode("utf-8", "replace") for c in chunks])
            index[new] = len(sizes) + np.arange(len(new))
            flat, sizes = np.concatenate([flat, more]), np.concatenate([sizes, counts])
            kept = max(0, min(len(new), REMEMBERED - len(self._known)))
            self._known.update(zip(chunks[:kept], index[new[:kept]].tolist(), strict=True))
            if kept:
                self._sizes = sizes[: len(self._sizes) + kept]
                self._flat = flat[: self._sizes.sum()]
        return flat, (np.cumsum(sizes) - sizes)[index], sizes[index]

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many chunks in one call: a chunk's last id is the one that ends a word."""
        parts = []
        for low in range(0, len(chunks), _AT_ONCE):
            some = chunks[low : low + _AT_ONCE]
            joined = self._library.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(joined[0].ids, dtype=self.dtype)
            stops = np.flatnonzero(self._ends[ids]) + 1
            if len(stops) == len(some) and stops[-1] == len(ids):
                parts.append((ids, np.diff(stops, prepend=0)))
                continue
            # Some chunk has several words, or none: each on its own.
            each = [e.ids for e in self._library.encode_batch_fast(some, add_special_tokens=False)]
            parts.append(
                (np.array([i for ids in each for i in ids], dtype=self.dtype), np.array([len(ids) for ids in each]))
            )
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([n for _, n in parts])


@lru_cache(maxsize=1)
def _chunk_ids(model: str) -> ChunkIds:
    """One per worker process, which runs many tasks."""
    return ChunkIds(model)


def chunks(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes without white space, where each chunk begins in them, and its document.

    A chunk is a run of letters, a digit or a run of other ASCII characters. Words the
    library may read otherwise stay whole: those with an apostrophe (it splits off
    "'s"), with ``<|`` (special tokens) or with characters outside Latin letters.
    """
    data = piece.data
    kind = _KIND[data]
    inside = kind != _SPACE
    begins = inside.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    edges = piece.offsets[:-1][np.diff(piece.offsets) > 0]
    begins[edges] = fresh[edges] = inside[edges]
    odd = _ODD[data]
    pair = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    odd[:-1] |= pair | ((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    starts = np.flatnonzero(begins)
    if odd.any():
        word_starts = np.flatnonzero(fresh)
        whole = np.zeros(len(word_starts), dtype=bool)
        whole[np.searchsorted(word_starts, np.flatnonzero(odd), side="right") - 1] = True
        first = fresh[starts]
        starts = starts[first | ~whole[np.cumsum(first) - 1]]
    before = np.cumsum(inside)  # bytes up to and with this one that are kept
    return data[inside], before[starts] - 1, owners(piece, starts)


def document_ids(piece: Piece, library: ChunkIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a piece, each with its end id, and where each begins."""
    data, starts, docs = chunks(piece)
    offsets = np.append(starts, len(data)).astype(np.int64)
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    encoded = pc.dictionary_encode(spans)
    flat, firsts, sizes = library.of(encoded.dictionary.to_pylist())
    codes = encoded.indices.to_numpy()
    firsts, count = firsts[codes], sizes[codes]
    at = np.cumsum(count) - count
    totals = np.bincount(docs, count, minlength=piece.count).astype(np.int64) + 1
    begins = np.concatenate([[0], np.cumsum(totals)])
    ids = np.full(begins[-1], END_ID, dtype=library.dtype)
    place = np.arange(int(count.sum()))
    # One end id lies before a chunk's ids for each document before its own.
    ids[place + np.repeat(docs, count)] = flat[place + np.repeat(firsts - at, count)]
    return ids, begins


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(model: str, groups: int, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, rows = _chunk_ids(model), TaskContext.get().partitionId() << 40
        for batch in batches:
            names = batch.column("doc_id")
            for piece in pieces(batch.column("text"), PIECE_BYTES):
                ids, begins = document_ids(piece, library)
                totals = np.diff(begins)
                count = -(-totals // limit)
                doc = np.repeat(np.arange(piece.count), count)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * limit
                length = np.minimum(totals[doc] - start, limit)
                low = begins[doc] + start
                whole = length == limit
                spans = [ids[a : a + n] for a, n in zip(low.tolist(), length.tolist(), strict=True)]
                group = mix(np.arange(rows, rows + len(doc)).astype(np.uint64)) % np.uint64(groups)
                rows += len(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group.astype(np.int64)),
                        names.slice(piece.first, piece.count).take(pa.array(doc)),
                        pa.array(start), pa.array(length), pa.array(totals[doc]),
                        pa.array([crc(s) if w else None for s, w in zip(spans, whole, strict=True)], pa.int64()),
                        pa.array([None if w else s.tobytes() for s, w in zip(spans, whole, strict=True)], pa.binary()),
                    ],
                    _PIECE_COLUMNS,
                )

    return run


class Tournament:
    """Free room of bins, opened from the left; finds the first that is wide enough."""

    def __init__(self, bins: int, room: int) -> None:
        self._leaves = 1 << max(0, bins - 1).bit_length()
        self._most = [room] * (2 * self._leaves)

    def place(self, size: int) -> int:
        """Put ``size`` into the first bin with room for it and return that bin."""
        most, node = self._most, 1
        while node < self._leaves:
            node *= 2
            node += most[node] < size
        found = node - self._leaves
        most[node] -= size
        while node > 1:
            node //= 2
            larger = max(most[2 * node], most[2 * node + 1])
            if most[node] == larger:
                break
            most[node] = larger
        return found


#: A span of a remainder: its number, its first id and how many ids.
Span = tuple[int, int, int]


def first_fit_decreasing(sizes: list[int], limit: int) -> list[list[Span]]:
    """Bins of whole items; ``sizes`` are in falling order and at most ``limit``."""
    tree, bins = Tournament(len(sizes), limit), []
    for item, size in enumerate(sizes):
        at = tree.place(size)
        if at == len(bins):
            bins.append([])
        bins[at].append((item, 0, size))
    return bins


def _move(source: list[Span], target: list[Span], most: int) -> int:
    """Move up to ``most`` ids of the last span; what is moved is cut from its end."""
    item, first, size = source.pop()
    moved = min(most, size)
    if moved < size:
        source.append((item, first, size - moved))
    target.append((item, first + size - moved, moved))
    return moved


def filled(bins: list[list[Span]], limit: int, slack: int) -> list[list[Span]]:
    """The same ids in bins that lack at most ``slack``, and some of powers of two."""
    bins = sorted(bins, key=lambda spans: -sum(size for _, _, size in spans))
    used = [sum(size for _, _, size in spans) for spans in bins]
    low, high = 0, len(bins) - 1
    while low < high:
        room = limit - used[low]
        if room <= slack:
            low += 1
            continue
        moved = _move(bins[high], bins[low], room)
        used[low] += moved
        used[high] -= moved
        if not used[high]:
            high -= 1
    if high < 0 or limit - used[high] <= slack:
        return bins[: high + 1]
    last, left = bins[high], used[high]
    out = bins[:high]
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        out.append([])
        while room:
            room -= _move(last, out[-1], room)
    return out


def _pack(limit: int, slack: int, dtype: str) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        group = rows[0]["group"]
        rows.sort(
            key=lambda r: (
                -r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"],
                r["doc_tokens"], r["ids"] or b"", r["ids_crc32"] or 0,
            )
        )
        out = [(r, r["start"], r["length"], r["ids_crc32"], n, 0) for n, r in enumerate(rows) if r["ids"] is None]
        rests = [r for r in rows if r["ids"] is not None]
        numbers = [np.frombuffer(r["ids"], dtype=dtype) for r in rests]
        bins = first_fit_decreasing([r["length"] for r in rests], limit)
        for number, spans in enumerate(filled(bins, limit, slack), len(out)):
            offset = 0
            for item, first, size in spans:
                ids = numbers[item][first : first + size]
                out.append((rests[item], rests[item]["start"] + first, size, crc(ids), number, offset))
                offset += size
        columns = [
            [r["doc_id"] for r, *_ in out], [o[1] for o in out], [o[2] for o in out], [o[3] for o in out],
            [r["doc_tokens"] for r, *_ in out], [(group << 32) + o[4] for o in out], [o[5] for o in out],
        ]
        names = [field.split()[0] for field in RESULT.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def pack(
    documents: DataFrame, model: str, limit: int = LIMIT, slack: int = SLACK, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """Pieces of all documents and where they lie: one row per piece, see ``RESULT``.

    ``model`` is a tokenizer's JSON that splits at white space. Between map and pack
    only the remainders' ids are shuffled, two bytes each in a small vocabulary.
    """
    if limit & (limit - 1):
        raise ValueError("a sequence's limit must be a power of two")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = max(1, -(-texts.count() // group_docs))
    cut = texts.mapInArrow(_cut(model, groups, limit), _PIECE)
    return cut.groupBy("group").applyInArrow(_pack(limit, slack, _chunk_ids(model).dtype.str), RESULT)


def read_model(path: str) -> str:
    """A tokenizer file on the driver; it travels with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def op13(documents: DataFrame) -> DataFrame:
    return pack(documents, read_model(public_tokenizers.path(TOKENIZER)))
