"""Vectorised reading of Arrow text: pieces, words and their hashes in numpy.

Texts are handled as UTF-8 bytes, many documents at a time. A word is a run of bytes
other than space, tab, line feed, vertical tab, form feed and carriage return, which
is the same as ``[^\\x20\\x09-\\x0D]+`` on characters. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time, unless one document is longer. Work arrays take
#: some 80 bytes per byte of text.
PIECE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Odd factors that place a word within its shingle.
_PLACES = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)


@dataclass(frozen=True)
class Piece:
    """Documents ``first`` up to ``last`` of a batch: their bytes, laid end to end."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return self.last - self.first


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=column.offset + len(column) + 1)
    offsets = offsets[column.offset :]
    if buffers[2] is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system: an idle worker keeps what its last task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # a library other than glibc has no such call
        trim(0)


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a string column into runs of whole documents of about ``most`` bytes."""
    data, offsets = text_bytes(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        low, high = offsets[first], offsets[last]
        yield Piece(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def powers(base: int, size: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for ``i`` below ``size``."""
    return _powers(base, 1 << max(10, int(size).bit_length()))[:size]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; one to one."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which any span's hash follows."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(_BASE, len(data))
    np.cumsum(terms, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal spans have equal hashes wherever they lie."""
    hashes = sums[ends] - sums[starts]
    hashes *= powers(_BASE_INVERSE, len(sums))[starts]
    return mix(hashes)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run never crosses documents."""
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document (counted from ``piece.first``) of each word."""
    starts, ends = runs(~IS_SPACE[piece.data], piece.offsets)
    return starts, ends, owners(piece, starts)


def owners(piece: Piece, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(piece.offsets, positions, side="right") - 1


def word_hashes(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z in lower case, and its document."""
    lowered = Piece(piece.first, piece.last, LOWER[piece.data], piece.offsets)
    starts, ends, docs = words(lowered)
    return span_hashes(prefix_sums(lowered.data), starts, ends), docs


def shingle_sets(piece: Piece, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted by document and hash.

    A document of fewer than ``width`` words has one shingle, its whole sequence; one
    without words has none. Returns hashes and documents.
    """
    hashes, docs = word_hashes(piece)
    counts = np.bincount(docs, minlength=piece.count)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    place = np.arange(len(hashes)) - firsts[docs]
    length = np.minimum(counts, width)
    whole = np.flatnonzero(place <= counts[docs] - length[docs])
    size = length[docs[whole]]
    shingles = size.astype(np.uint64) * np.uint64(_BASE)
    for step in range(width):
        rows = np.flatnonzero(size > step)
        shingles[rows] += hashes[whole[rows] + step] * _PLACES[step]
    shingles, docs = mix(shingles), docs[whole]
    order = np.lexsort((shingles, docs))
    shingles, docs = shingles[order], docs[order]
    fresh = np.ones(len(docs), dtype=bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (docs[1:] != docs[:-1])
    return shingles[fresh], docs[fresh]


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as the 64-bit integers that Spark has."""
    return values.view(np.int64)
