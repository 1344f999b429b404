"""Quality scores by a factorisation machine.

A document's features are its hashed words (A-Z in lower case, weighted by how often
they occur, the weights of one document having length 1), statistics of its structure
(shares of letters, digits, punctuation and the like, word and line lengths, repeated
words and lines), each cut into steps, and the recorded length as metadata. Language,
source and id are no features. The machine has a weight per feature and, for every pair
of features, the product of two short vectors; with the sum-of-squares identity

    sum over pairs <v_i, v_j> x_i x_j = 1/2 sum over f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)

a document costs as much as it has features.

Learnt from at most ``SAMPLE_DOCS`` labelled documents, those with the smallest hashes
of their ids (see :func:`fit`); every text is scored whole.

Defined cases: null and empty texts are scored from structure and metadata alone; a
null length is a step of its own; labels that are null or belong to no document are
left out, and of several labels of one id the largest counts; if nothing can be learnt,
all scores are 0.5; rows that repeat a ``doc_id`` are scored each; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.llm.folders import crc_of_id
from pacefold.llm.text import LOWER, Piece, mix, pieces, prefix_sums, runs, span_hashes, words

#: Hashed words are told apart up to this many.
WORD_FEATURES = 1 << 15
#: Length of the vectors whose products weigh pairs of features.
FACTORS = 8
#: Documents that the machine is fitted to, at most.
SAMPLE_DOCS = 6000
EPOCHS = 12
BATCH = 128

_SHARE_STEPS = np.array([0.0, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99])
_LENGTH_STEPS = np.array([0.0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20, 30, 50, 100, 1000])
_COUNT_STEPS = np.concatenate([[0], 2.0 ** np.arange(0, 22)])
_STEPS = 24


def _byte_class(*ranges: tuple[str, str]) -> np.ndarray:
    table = np.zeros(256, dtype=np.int32)
    for low, high in ranges:
        table[ord(low) : ord(high) + 1] = 1
    return table


_CLASSES = [
    _byte_class(("a", "z")),
    _byte_class(("A", "Z")),
    _byte_class(("0", "9")),
    _byte_class(("\x80", "\xff")),
    _byte_class((" ", " ")),
    _byte_class(("\n", "\n"), ("\r", "\r")),
    _byte_class((",", ","), (".", ".")),
    _byte_class(("!", "!"), ("?", "?")),
    _byte_class(("#", "&"), ("*", "*"), ("@", "@"), ("^", "^"), ("~", "~")),
    _byte_class(("|", "|"), ("<", ">"), ("{", "}"), ("[", "]"), ("_", "_"), ("\\", "\\"), ("/", "/")),
    _byte_class(("\x00", "\x08"), ("\x0e", "\x1f")),
]
#: Shares of byte classes, then the other statistics, then the metadata.
STRUCTURE = len(_CLASSES) + 9
FEATURES = WORD_FEATURES + STRUCTURE * _STEPS


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _per_doc(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(starts, offsets))


def _distinct(hashes: np.ndarray, docs: np.ndarray, count: int) -> np.ndarray:
    pairs = np.unique(mix(hashes) ^ mix(docs.astype(np.uint64)), return_index=True)[1]
    return np.bincount(docs[pairs], minlength=count)


def structure(piece: Piece, recorded: np.ndarray, bounds: tuple, hashes: np.ndarray) -> np.ndarray:
    """The step of every statistic, one row per document."""
    starts, ends, docs = bounds
    size = np.diff(piece.offsets)
    columns = []
    for table in _CLASSES:
        sums = np.concatenate([[0], np.cumsum(table[piece.data])])
        columns.append((_shares(np.diff(sums[piece.offsets]), size), _SHARE_STEPS))
    n_words = _per_doc(starts, piece.offsets)
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.searchsorted(starts, piece.offsets)
    longest = np.zeros(piece.count)
    np.maximum.at(longest, docs, ends - starts)
    line_starts, line_ends = runs(piece.data != 0x0A, piece.offsets)
    line_docs = np.searchsorted(piece.offsets, line_starts, side="right") - 1
    n_lines = _per_doc(line_starts, piece.offsets)
    line_hashes = span_hashes(prefix_sums(piece.data), line_starts, line_ends)
    columns += [
        (_shares(np.diff(lengths[at]), n_words), _LENGTH_STEPS),
        (longest, _LENGTH_STEPS),
        (_shares(_distinct(hashes, docs, piece.count), n_words), _SHARE_STEPS),
        (n_words, _COUNT_STEPS),
        (n_lines, _COUNT_STEPS),
        (_shares(size, n_lines), _COUNT_STEPS),
        (_shares(_distinct(line_hashes, line_docs, piece.count), n_lines), _SHARE_STEPS),
        (_shares(n_words, n_lines), _COUNT_STEPS),
        (recorded, _COUNT_STEPS),  # null is not a number and sorts behind all steps
    ]
    return np.stack([np.searchsorted(steps, values, side="right") for values, steps in columns], 1)


@dataclass(frozen=True)
class Rows:
    """Features of some documents, laid end to end; each document has some."""

    begins: np.ndarray
    index: np.ndarray
    value: np.ndarray


def features(piece: Piece, recorded: np.ndarray) -> Rows:
    lowered = Piece(piece.first, piece.last, LOWER[piece.data], piece.offsets)
    bounds = words(lowered)
    hashes = span_hashes(prefix_sums(lowered.data), bounds[0], bounds[1])
    steps = structure(piece, recorded, bounds, hashes)
    docs = np.repeat(np.arange(piece.count), STRUCTURE)
    index = WORD_FEATURES + np.arange(STRUCTURE) * _STEPS + steps
    keys = bounds[2] * WORD_FEATURES + (hashes % np.uint64(WORD_FEATURES)).astype(np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    owner, weight = keys // WORD_FEATURES, np.sqrt(counts)
    norm = np.sqrt(np.bincount(owner, counts, minlength=piece.count))
    weight = weight / norm[owner]
    all_docs = np.concatenate([docs, owner])
    order = np.argsort(all_docs, kind="stable")
    return Rows(
        np.searchsorted(all_docs[order], np.arange(piece.count)),
        np.concatenate([index.reshape(-1), keys % WORD_FEATURES])[order].astype(np.int32),
        np.concatenate([np.full(len(docs), 1 / np.sqrt(STRUCTURE)), weight])[order].astype(np.float32),
    )


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def outputs(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds, and what their gradient needs."""
        spread = self.factors[rows.index] * rows.value[:, None]
        sums = np.add.reduceat(spread, rows.begins, axis=0)
        squares = np.add.reduceat(spread * spread, rows.begins, axis=0)
        linear = np.add.reduceat(self.weights[rows.index] * rows.value, rows.begins)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, spread

    def scores(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.outputs(rows)[0].astype(np.float64), -30, 30)))


#: Weight of half the squared parameters in the loss.
SHRINK = 1e-5


def gradients(machine: Machine, rows: Rows, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Features that the rows have, and the gradient of the mean logistic loss by each one's
    weight and factors (shrinkage included); last, the gradient by the bias."""
    sizes = np.diff(np.append(rows.begins, len(rows.index)))
    outputs, sums, spread = machine.outputs(rows)
    error = 1 / (1 + np.exp(-np.clip(outputs, -30, 30))) - labels
    pull = np.repeat(error / len(labels), sizes) * rows.value
    steps = np.empty((len(rows.index), FACTORS + 1), dtype=np.float32)
    steps[:, 0] = pull
    steps[:, 1:] = pull[:, None] * (np.repeat(sums, sizes, axis=0) - spread)
    touched, place = np.unique(rows.index, return_inverse=True)
    grouped = np.argsort(place, kind="stable")
    firsts = np.searchsorted(place[grouped], np.arange(len(touched)))
    gradient = np.add.reduceat(steps[grouped], firsts, axis=0)
    gradient[:, 0] += SHRINK * machine.weights[touched]
    gradient[:, 1:] += SHRINK * machine.factors[touched]
    return touched, gradient, float(error.mean())


def train(rows: Rows, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.15) -> Machine:
    """Logistic loss by adaptive gradient steps, in a fixed order."""
    pick = np.random.default_rng(17)
    prior = np.clip(labels.mean(), 0.02, 0.98)
    machine = Machine(
        float(np.log(prior / (1 - prior))),
        np.zeros(FEATURES, dtype=np.float32),
        pick.normal(0, 0.05, (FEATURES, FACTORS)).astype(np.float32),
    )
    seen = np.full((FEATURES, FACTORS + 1), 1e-3, dtype=np.float32)
    ends = np.append(rows.begins[1:], len(rows.index))
    for _ in range(epochs):
        order = pick.permutation(len(labels))
        for low in range(0, len(order), BATCH):
            some = order[low : low + BATCH]
            sizes = ends[some] - rows.begins[some]
            begins = np.cumsum(sizes) - sizes
            take = np.arange(sizes.sum()) + np.repeat(rows.begins[some] - begins, sizes)
            part = Rows(begins, rows.index[take], rows.value[take])
            touched, gradient, error = gradients(machine, part, labels[some])
            seen[touched] += gradient * gradient
            move = rate * gradient / np.sqrt(seen[touched])
            machine.weights[touched] -= move[:, 0]
            machine.factors[touched] -= 0.3 * move[:, 1:]
            machine.bias -= rate * 0.1 * error
    return machine


def _recorded(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        recorded = _recorded(batch)
        for piece in pieces(batch.column("text")):
            rows = features(piece, recorded[piece.first : piece.last])
            offsets = pa.array(np.append(rows.begins, len(rows.index)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(piece.first, piece.count),
                    batch.column("quality").slice(piece.first, piece.count),
                    pa.ListArray.from_arrays(offsets, pa.array(rows.index)),
                    pa.ListArray.from_arrays(offsets, pa.array(rows.value)),
                ],
                ["doc_id", "quality", "index", "value"],
            )


def fit(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Machine | None:
    """Fit to the ``sample_docs`` labelled documents with the smallest hash of their id.

    Their features, a few hundred numbers a document, come to the driver.
    """
    sample = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .join(documents.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )
    found = (
        documents.join(F.broadcast(sample), "doc_id")
        .select("doc_id", F.col("quality").cast("int").alias("quality"), "text", "n_chars")
        .mapInArrow(_read, "doc_id long, quality int, index array<int>, value array<float>")
        .toArrow()
        .sort_by("doc_id")
        .combine_chunks()
    )
    if not found.num_rows:
        return None
    lists = found["index"].chunk(0)
    rows = Rows(
        lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(),
        lists.flatten().to_numpy(),
        found["value"].chunk(0).flatten().to_numpy(),
    )
    return train(rows, found["quality"].to_numpy().astype(np.float32))


def score(documents: DataFrame, machine: Machine | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            recorded, scores = _recorded(batch), np.full(batch.num_rows, 0.5)
            for piece in pieces(batch.column("text")) if fitted else ():
                rows = features(piece, recorded[piece.first : piece.last])
                scores[piece.first : piece.last] = fitted.scores(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return documents.select("doc_id", "held_out", "text", "n_chars").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document, learning labels from two thirds of the ids."""
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.col("n_chars").cast("long").alias("n_chars"),
        (crc_of_id(3) == 1).alias("held_out"),
    )
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    return score(read, fit(read.where("not held_out"), known.where(crc_of_id(3) != 1)))


def op10(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score_quality(documents, labels)
