"""Runs of repeating words, by Kruskal's algorithm over suffixes in order of falling LCP.

A run is a stretch of words that repeats with a smallest period ``q`` at least ``REPEATS``
times over, and cannot be made longer. It shows as two suffixes a period apart whose
longest common prefix (LCP) is the run's length less ``q``. Between them starts no third
suffix that agrees as far, or the period would be smaller. So:

1. The suffixes of a document are put in order by prefix doubling, and neighbours in that
   order are joined by an edge with their LCP. Only suffixes whose first few words occur
   twice in the document take part (fewer words in common make no run).
2. Edges are taken by falling LCP, and union-find unites the classes at their ends. A
   class keeps its positions in order; the smaller is merged into the larger.
3. When two positions become neighbours in a class, their LCP is that of the edge. If
   they are near enough to each other, they seed a run with their distance as period.
4. The seed whose left neighbours differ begins a run; its LCP says where it ends. Every
   run has exactly one such seed.

Words are compared exactly: they are numbered by a dictionary; hashes only sort out
suffixes that cannot take part. A document is the work of one task: n words need some n
log n steps and 200 bytes a word.

Defined cases: null and empty texts have no words and no runs; rows that repeat an id, or
have none, are documents of their own (``op11`` rewrites no document without an id);
equal words are equal bytes, upper and lower case differ; further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.llm.text import IS_SPACE, Piece, mix, owners, pieces, words

#: Words of a run, and times its period, at least.
LEAST_WORDS = 6
REPEATS = 4

_SPACES = "[\\x20\\x09-\\x0D]+"
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def seed_width(least_words: int = LEAST_WORDS, repeats: int = REPEATS) -> int:
    """The smallest LCP that can seed a run: of a run of period q, max(words - q, (repeats - 1) q)."""
    return min(max(least_words - q, (repeats - 1) * q) for q in range(1, least_words + 1))


def word_numbers(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, document and number of each word; equal words have equal numbers."""
    starts, ends, docs = words(piece)
    letters = piece.data[~IS_SPACE[piece.data]]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    strings = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    numbers = pc.dictionary_encode(strings).indices.to_numpy().astype(np.int64)
    return starts, ends, docs, numbers


def repeated_starts(numbers: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
    """Positions whose next ``width`` words occur at another position of the document.

    By hash, so that now and then one more is returned.
    """
    many = len(numbers) - width + 1
    if many < 2:
        return np.zeros(0, dtype=np.int64)
    inside = np.flatnonzero(docs[:many] == docs[width - 1 :])
    spread = mix(numbers.astype(np.uint64))
    gram = mix(docs.astype(np.uint64))[inside]
    for step in range(width):
        gram = mix(gram ^ spread[inside + step])
    order = np.argsort(gram)
    same = gram[order[1:]] == gram[order[:-1]]
    twice = np.zeros(len(inside), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return inside[twice]


class Suffixes:
    """Some suffixes of documents in order, as far as they agree by ``width`` words or more."""

    def __init__(self, numbers: np.ndarray, docs: np.ndarray, width: int) -> None:
        self._numbers, self._docs, self._width = numbers, docs, width
        starts = repeated_starts(numbers, docs, width)
        # Those a step further on decide between suffixes that agree in one step.
        ahead = starts + width
        ahead = ahead[ahead < len(docs)]
        self.at = np.union1d(starts, ahead[docs[ahead] == docs[ahead - width]])
        self._place = np.full(len(numbers) + 1, -1, dtype=np.int64)
        self._place[self.at] = np.arange(len(self.at))
        self._ranks = [self._first_ranks()]
        self._double()

    def _first_ranks(self) -> np.ndarray:
        """Rank by document and first words: the number of smaller suffixes."""
        keys = [self._beyond(self.at, step) for step in reversed(range(self._width))]
        order = np.lexsort([*keys, self._docs[self.at]])
        fresh = np.ones(len(order), dtype=bool)
        for key in (self._docs[self.at], *keys):
            key = key[order]
            fresh[1:] &= key[1:] == key[:-1]
        fresh[1:] = ~fresh[1:]
        return _ranked(order, fresh)

    def _ahead(self, rows: np.ndarray, rank: np.ndarray, step: int) -> np.ndarray:
        """Rank of the suffix ``step`` words further on, plus 1; 0 behind the end."""
        at = self.at[rows]
        there = np.minimum(at + step, len(self._docs))
        inside = there < len(self._docs)
        inside[inside] = self._docs[there[inside]] == self._docs[at[inside]]
        place = self._place[np.where(inside, there, len(self._docs))]
        # A suffix that agrees with another this far has its continuation among ours.
        return np.where(place >= 0, rank[place] + 1, 0)

    def _double(self) -> None:
        """Order by twice as many words, until no two suffixes agree."""
        step = self._width
        tied = np.flatnonzero(_group_sizes(self._ranks[0]) > 1)
        while len(tied):
            rank = self._ranks[-1]
            ahead = self._ahead(tied, rank, step)
            order = np.lexsort([ahead, rank[tied]])
            row, first, second = tied[order], rank[tied][order], ahead[order]
            new_group = np.ones(len(row), dtype=bool)
            new_group[1:] = first[1:] != first[:-1]
            fresh = new_group.copy()
            fresh[1:] |= second[1:] != second[:-1]
            index = np.arange(len(row))
            within = np.maximum.accumulate(np.where(fresh, index, 0)) - np.maximum.accumulate(
                np.where(new_group, index, 0)
            )
            finer = rank.copy()
            finer[row] = first + within
            self._ranks.append(finer)
            step *= 2
            tied = tied[_group_sizes(finer)[tied] > 1]

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours in order that agree by ``width`` words or more, and their LCP."""
        order = np.argsort(self._ranks[-1], kind="stable")
        first = self._ranks[0][order]
        near = np.flatnonzero(first[1:] == first[:-1])
        left, right = order[near], order[near + 1]
        x, y = self.at[left], self.at[right]
        a, b, lcp = x.copy(), y.copy(), np.zeros(len(x), dtype=np.int64)
        for level in reversed(range(len(self._ranks))):
            rank = self._ranks[level]
            both = np.flatnonzero((self._place[a] >= 0) & (self._place[b] >= 0))
            same = both[rank[self._place[a[both]]] == rank[self._place[b[both]]]]
            size = self._width << level
            a[same] += size
            b[same] += size
            lcp[same] += size
        for _ in range(self._width - 1):
            word = self._beyond(x, lcp)
            lcp = lcp + ((word > 0) & (word == self._beyond(y, lcp)))
        return x, y, lcp

    def _beyond(self, at: np.ndarray, steps: np.ndarray | int) -> np.ndarray:
        """The word so many steps further on in the document; 0 behind its end."""
        there = np.minimum(at + steps, len(self._docs) - 1)
        inside = (at + steps < len(self._docs)) & (self._docs[there] == self._docs[at])
        return np.where(inside, self._numbers[there] + 1, 0)


def _ranked(order: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return rank


def _group_sizes(rank: np.ndarray) -> np.ndarray:
    return np.bincount(rank, minlength=len(rank))[rank]


def seeds(
    left: np.ndarray, right: np.ndarray, lcp: np.ndarray, least_words: int, repeats: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position, period and LCP of the pairs that seed runs, by uniting classes."""
    order = np.argsort(-lcp, kind="stable")
    positions = np.union1d(left, right)
    members: list[list[int] | None] = [[p] for p in positions.tolist()]
    parent = list(range(len(positions)))
    ends = np.searchsorted(positions, left[order]), np.searchsorted(positions, right[order])
    found: list[tuple[int, int, int]] = []
    times = repeats - 1
    for one, other, agree in zip(ends[0].tolist(), ends[1].tolist(), lcp[order].tolist(), strict=True):
        while parent[one] != one:
            parent[one] = one = parent[parent[one]]
        while parent[other] != other:
            parent[other] = other = parent[parent[other]]
        large, small = members[one], members[other]
        if len(large) < len(small):
            one, other, large, small = other, one, small, large
        parent[other], members[other] = one, None
        before, last = -1, len(small) - 1
        for k, position in enumerate(small):
            at = bisect_left(large, position)
            large.insert(at, position)
            if at:
                near = large[at - 1]
                gap = position - near
                if near != before and gap * times <= agree and gap + agree >= least_words:
                    found.append((near, gap, agree))
            if at + 1 < len(large):
                near = large[at + 1]
                gap = near - position
                if gap * times <= agree and gap + agree >= least_words and (k == last or small[k + 1] > near):
                    found.append((position, gap, agree))
            before = position
    columns = np.array(found, dtype=np.int64).reshape(-1, 3).T
    return columns[0], columns[1], columns[2]


def runs_of(
    numbers: np.ndarray, docs: np.ndarray, least_words: int = LEAST_WORDS, repeats: int = REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period; no run crosses documents."""
    suffixes = Suffixes(numbers, docs, seed_width(least_words, repeats))
    start, period, agree = seeds(*suffixes.edges(), least_words, repeats)
    before = np.maximum(start - 1, 0)
    inside = (start > 0) & (docs[before] == docs[start]) if len(start) else start > 0
    begins = ~inside | (numbers[before] != numbers[before + period]) if len(start) else inside
    start, period, agree = start[begins], period[begins], agree[begins]
    order = np.lexsort([period, start])
    return start[order], (agree + period)[order], period[order]


def collapsed(piece: Piece, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> list[bytes]:
    """Each document's kept words joined by one space."""
    # Every kept word with the character behind it, if that is white space of its document.
    last = np.zeros(len(piece.data) + 1, dtype=bool)
    last[piece.offsets[1:]] = True
    stops = ends + ~last[ends]
    change = np.zeros(len(piece.data) + 1, dtype=np.int32)
    change[starts[kept]] += 1
    np.add.at(change, stops[kept], -1)
    inside = np.cumsum(change[:-1]) > 0
    letters = np.where(IS_SPACE[piece.data], np.uint8(0x20), piece.data)[inside].tobytes()
    cuts = np.concatenate([[0], np.cumsum(inside)])[piece.offsets].tolist()
    return [
        letters[a : b - (b > a and letters[b - 1] == 0x20)] for a, b in zip(cuts, cuts[1:], strict=False)
    ]


def _described(piece: Piece, least_words: int, repeats: int) -> Iterator[tuple]:
    """Number of words, runs (start, length, period) and collapsed text of each document."""
    starts, ends, docs, numbers = word_numbers(piece)
    start, length, period = runs_of(numbers, docs, least_words, repeats)
    change = np.zeros(len(starts) + 1, dtype=np.int32)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    texts = collapsed(piece, starts, ends, np.cumsum(change[:-1]) == 0)
    counts = np.bincount(docs, minlength=piece.count)
    firsts = np.cumsum(counts) - counts
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(piece.count)]
    of = docs[start]
    for doc, *run in zip(of.tolist(), (start - firsts[of]).tolist(), length.tolist(), period.tolist(), strict=True):
        runs[doc].append(tuple(run))
    yield from zip(counts.tolist(), runs, texts, strict=True)


def _each(describe: Callable, least_words: int, repeats: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for piece in pieces(batch.column("text")):
                names = ids.slice(piece.first, piece.count)
                yield describe(names, _described(piece, least_words, repeats))

    return run


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def periodic_runs(documents: DataFrame, least_words: int = LEAST_WORDS, repeats: int = REPEATS) -> DataFrame:
    """Per document its runs in order of start and period, and its text without repeats.

    The collapsed text lacks the words that a run contains after its first period. Runs
    have ``least_words`` words and ``repeats`` times their period at least (2 or more).
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    fields = ("start", "length", "period")

    def describe(names: pa.Array, rows: Iterator[tuple]) -> pa.RecordBatch:
        counts, runs, texts = zip(*rows, strict=True)
        lists = [[dict(zip(fields, run, strict=True)) for run in some] for some in runs]
        return pa.RecordBatch.from_arrays(
            [names, pa.array(counts, pa.int64()), pa.array(lists, kind), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    return _texts(documents).mapInArrow(_each(describe, least_words, repeats), RUNS)


def _strongest(runs: list[tuple[int, int, int]]) -> tuple:
    """The run with the greatest length per period; then smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return (*best, 1000 * best[1] // best[2]) if best else (None,) * 4


def _digests(names: pa.Array, rows: Iterator[tuple]) -> pa.RecordBatch:
    out = []
    for _, runs, text in rows:
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        out.append(
            (len(runs), *_strongest(runs), hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest())
        )
    types = [*[pa.int64()] * 5, pa.string(), pa.string()]
    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays([names, *columns], [f.split()[0] for f in RESULT.split(", ")])


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the documents, by their ids, repeat their own words.

    With ``h = crc32(doc_id)``, ``g = h // 10`` and n words, if ``h % 10 = 0`` each word
    ``i >= a`` becomes word ``a + (i - a) % p``, for ``a = g % n`` and
    ``p = 1 + (n - a) // (3 + g % 8)``; the words are then joined by spaces.
    """
    digest = F.crc32(F.col("doc_id").cast("string"))
    tokens = F.filter(F.split("text", _SPACES), lambda word: word != "")
    marked = _texts(documents).withColumn("_h", digest)
    split = marked.where("_h % 10 = 0").withColumn("_words", F.coalesce(tokens, F.array().cast("array<string>")))
    g, n = F.floor(F.col("_h") / 10), F.size("_words")
    a = F.when(n > 0, g % n)
    shaped = split.select("doc_id", "_words", a.alias("_a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("_p"))

    def source(word: Column, i: Column) -> Column:
        return F.when(i < F.col("_a"), word).otherwise(
            F.get(F.col("_words"), (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))
        )

    repeated = shaped.select("doc_id", F.array_join(F.transform("_words", source), " ").alias("text"))
    return marked.where("_h is null or _h % 10 != 0").select("doc_id", "text").union(repeated)


def op11(documents: DataFrame) -> DataFrame:
    """The strongest run of each document, and digests of all runs and of its kept words."""
    return with_planted_periods(documents).mapInArrow(_each(_digests, LEAST_WORDS, REPEATS), RESULT)
