"""Scoring documents with a recurrent language model.

Tokens are words, A-Z in lower case, and one end per document. Counts of all training
documents give a unigram base and the model's vocabulary, the ``VOCABULARY`` most
frequent tokens; all others are one unknown word to the network (see
:mod:`pacefold.llm.gru`), whose probability is shared out among them by their counts, with
one more for tokens never seen. So every token of every text has a probability, and the
score is the log10 probability of the whole text: the state is carried through all
windows from a document's first token to its end.

Counts and weights are learnt from all training documents, at every size. They are dealt
into shards, and the shards into ``ROUNDS`` rounds. The shards of a round are trained side
by side, each by truncated backpropagation from the weights of the round before, and their
weights averaged. So every token of every training document teaches once.

Defined cases: null and empty texts are an end alone; with nothing to learn from, all
scores are 0 like the base; rows that repeat a ``doc_id`` count and are scored each;
documents without an id belong to the fold of the empty id; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.llm import gru, postings
from pacefold.llm.folders import crc_of_id, partitions, stored
from pacefold.llm.text import Piece, mix, pieces, signed, word_hashes

VOCABULARY = 2046
#: Tokens of a shard, about, and rounds of averaging, with their rates of learning.
SHARD_TOKENS = 2_000_000
ROUNDS = 6
RATES = tuple(0.02 * 0.25 ** (r / (ROUNDS - 1)) for r in range(ROUNDS))
#: Tasks that average the shards' weights; what they give meets on the driver.
AVERAGERS = 8
#: Tokens scored side by side, about.
SCORED_TOKENS = 4_000_000
#: Tokens whose counts a task combines before it sends them.
COUNTED_TOKENS = 4_000_000

#: Bits of a hash that the lookup of frequent tokens goes by.
_SLOT_BITS = 16
_CROWDED = -1

#: Stands for the end of a document among the words' hashes.
END = mix(np.array([0x0E4D], dtype=np.uint64))[0]


def tokens(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens and the offsets of the documents among them."""
    hashes, docs = word_hashes(piece)
    sizes = np.bincount(docs, minlength=piece.count) + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(offsets[-1], END, dtype=np.uint64)
    out[np.arange(len(hashes)) + docs] = hashes
    return out, offsets


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        # Counted in a hash table, which is several times faster than in order.
        found = pc.value_counts(pa.array(signed(np.concatenate(held))))
        return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["token", "n"])

    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch.column("text")):
            held.append(tokens(piece)[0])
            size += len(held[-1])
            if size >= COUNTED_TOKENS:
                yield rows(held)
                held, size = [], 0
    if size:
        yield rows(held)


@dataclass(frozen=True)
class Vocabulary:
    """The frequent tokens, unknown ones and sums over all tokens.

    ``hashes`` are sorted; ``ids`` are their numbers in the network, where the unknown
    word has one too.
    """

    hashes: np.ndarray
    ids: np.ndarray
    logs: np.ndarray  # log10(count + 1) of each hash
    unknown: int
    frequency: np.ndarray  # by number
    total: int
    distinct: int

    @cached_property
    def _slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By the first bits of a hash: the hash known there, its number and log.

        Where several share these bits, the number is ``_CROWDED``.
        """
        slot = (self.hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        hashes = np.zeros(1 << _SLOT_BITS, dtype=np.uint64)
        # An empty slot holds a hash that does not belong there, so nothing equals it.
        hashes[0] = ~np.uint64(0)
        numbers = np.full(1 << _SLOT_BITS, self.unknown, dtype=np.int64)
        logs = np.zeros(1 << _SLOT_BITS)
        hashes[slot], numbers[slot], logs[slot] = self.hashes, self.ids, self.logs
        crowded = np.flatnonzero(np.bincount(slot, minlength=1) > 1)
        numbers[crowded] = _CROWDED
        return hashes, numbers, logs

    def lookup(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each token, and log10(count + 1), 0 for unknown ones."""
        hashes, by_slot, logs_by_slot = self._slots
        slot = (found >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        numbers, same = by_slot[slot], hashes[slot] == found
        logs = np.where(same, logs_by_slot[slot], 0.0)
        crowded = np.flatnonzero(numbers == _CROWDED)
        numbers[~same] = self.unknown
        if len(crowded):
            at = np.minimum(np.searchsorted(self.hashes, found[crowded]), len(self.hashes) - 1)
            known = self.hashes[at] == found[crowded]
            numbers[crowded] = np.where(known, self.ids[at], self.unknown)
            logs[crowded] = np.where(known, self.logs[at], 0.0)
        return numbers, logs

    @property
    def unknown_room(self) -> float:
        """What the counts of unknown tokens are divided by: each and one more."""
        rest = self.total - int(self.frequency.sum() - self.frequency[self.unknown])
        return rest + self.distinct - len(self.hashes) + 1.0


def learn_vocabulary(training: DataFrame) -> Vocabulary:
    counts = stored(
        training.select("text")
        .mapInArrow(_count, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n")),
        "token-counts",
    )
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = sums[0] or 0, sums[1]
    top = counts.orderBy(F.desc("n"), "token").limit(VOCABULARY).toArrow()
    hashes = top["token"].to_numpy().view(np.uint64)
    frequency = top["n"].to_numpy()
    everything = np.append(frequency, total - frequency.sum())
    order = np.argsort(-everything, kind="stable")
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    by_hash = np.argsort(hashes)
    return Vocabulary(
        hashes[by_hash], number[:-1][by_hash], np.log10(frequency[by_hash] + 1.0),
        int(number[-1]), everything[order], total, distinct,
    )


def learn_network(training: DataFrame, vocabulary: Vocabulary) -> gru.Network:
    """Train the shards of each round side by side and average their weights."""
    network = gru.new_network(vocabulary.frequency)
    if not vocabulary.total:
        return network
    spark = training.sparkSession
    texts = stored(shards(training, vocabulary), "language-model-shards")
    for number, rate in enumerate(RATES):
        shared = spark.sparkContext.broadcast(network)
        own = texts.where(F.col("round") == number).select("words", "sizes")
        trained = own.mapInArrow(_train_shards(shared, rate), _WEIGHTS)
        # Added up in a fixed order, so that a rerun gives the same doubles.
        means = (
            trained.repartition(AVERAGERS, "part")
            .sortWithinPartitions("task")
            .mapInArrow(_add_up, _WEIGHTS)
            .toArrow()
        )
        if means.num_rows:  # a small table may have no shard in some round
            values = [np.frombuffer(v, dtype=np.float64) for v in means["values"].to_pylist()]
            network = gru.restored(network, sum(values) / sum(means["n"].to_pylist()))
    return network


def shards(training: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All documents as numbers of the network: ``round, words, sizes``, a shard a row."""
    spark = training.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)
    count = max(ROUNDS, round(vocabulary.total / SHARD_TOKENS))
    # Dealt by id and text, not by the order of arrival: a task that is run again sees
    # the same, and rows without an id are spread too.
    numbered = training.select(F.xxhash64("doc_id", "text").alias("deal"), "text").mapInArrow(
        _number(known), "deal long, words binary"
    )
    return (
        numbered.withColumn("shard", F.pmod("deal", F.lit(count)))
        .repartition(partitions(spark), "shard")
        .sortWithinPartitions("shard", "deal")
        .mapInArrow(_gather, "round int, words binary, sizes binary")
    )


def _number(shared) -> Callable:
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for piece in pieces(batch.column("text")):
                found, offsets = tokens(piece)
                words = np.split(known.lookup(found)[0], offsets[1:-1])
                blobs = pa.array([postings.pack(w) for w in words], pa.binary())
                deal = batch.column("deal").slice(piece.first, piece.count)
                yield pa.RecordBatch.from_arrays([deal, blobs], ["deal", "words"])

    return number


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lay a shard's documents end to end; one far above its size goes on as several."""

    def row() -> pa.RecordBatch:
        blobs = [postings.pack(np.concatenate(held)), postings.pack(np.array([len(h) for h in held]))]
        return pa.RecordBatch.from_arrays(
            [pa.array([last % ROUNDS], pa.int32()), *(pa.array([b], pa.binary()) for b in blobs)],
            ["round", "words", "sizes"],
        )

    held, size, last = [], 0, None
    for batch in batches:
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("words"), strict=True):
            if held and (shard != last or size >= 2 * SHARD_TOKENS):
                yield row()
                held, size = [], 0
            held.append(postings.unpack(blob.as_py()))
            size, last = size + len(held[-1]), shard
    if held:
        yield row()


_WEIGHTS = "part long, task long, values binary, n long"


def _train_shards(shared, rate: float) -> Callable:
    """Train a task's shards one after the other, each from the shared weights."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in batches:
            for words, sizes in zip(batch.column("words"), batch.column("sizes"), strict=True):
                offsets = np.concatenate([[0], np.cumsum(postings.unpack(sizes.as_py()).astype(np.int64))])
                numbers = postings.unpack(words.as_py()).astype(np.int64)
                values = gru.flatten(gru.train(shared.value, numbers, offsets, rate))
                total, n = total + values.astype(np.float64), n + 1
        if n:
            yield _weights(TaskContext.get().partitionId(), total, n)

    return train


def _weights(task: int, values: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([task % AVERAGERS]), pa.array([task]),
            pa.array([values.tobytes()], pa.binary()), pa.array([n]),
        ],
        ["part", "task", "values", "n"],
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = 0.0, 0
    for batch in batches:
        for values, some in zip(batch.column("values"), batch.column("n").to_pylist(), strict=True):
            total, n = total + np.frombuffer(values.as_py(), dtype=np.float64), n + some
    if n:
        yield _weights(0, total, n)


def _read(shared) -> Callable:
    """Score the frequent tokens' part of each text and ask for the others' counts."""

    def reader(parts: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sequence, held, size = 0, [], 0
            for batch in batches:
                ids, held_out = batch.column("doc_id"), batch.column("held_out")
                for piece in pieces(batch.column("text")):
                    found, offsets = tokens(piece)
                    rows = (piece.first, piece.count)
                    held.append((found, offsets, ids.slice(*rows), held_out.slice(*rows)))
                    size += len(found)
                    if size >= SCORED_TOKENS:
                        yield from _flush(held, sequence, parts, *shared.value)
                        sequence, held, size = sequence + 1, [], 0
            if held:
                yield from _flush(held, sequence, parts, *shared.value)

        return run

    return reader


def _flush(
    held: list, sequence: int, parts: int, network: gru.Network, vocabulary: Vocabulary
) -> Iterator[pa.RecordBatch]:
    found = np.concatenate([h[0] for h in held])
    sizes = np.concatenate([np.diff(h[1]) for h in held])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    docs = np.repeat(np.arange(len(sizes)), sizes)
    numbers, logs = vocabulary.lookup(found)
    held_out = pa.concat_arrays([h[3] for h in held])
    known_logs = np.bincount(docs, logs, minlength=len(sizes))
    unknown = np.bincount(docs, numbers == vocabulary.unknown, minlength=len(sizes)).astype(np.int64)
    network_score = gru.score(network, numbers, offsets) / np.log(10)
    info = pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([h[2] for h in held]), held_out, pa.array(sizes), pa.array(known_logs),
            pa.array(unknown), pa.array(network_score),
        ],
        ["doc_id", "held_out", "n_tokens", "known_logs", "n_unknown", "network_score"],
    )
    # The counts of frequent tokens are known; the others' are asked for.
    rare = numbers == vocabulary.unknown
    batch = postings.count(found[rare], docs[rare])
    learnt = ~held_out.to_numpy(zero_copy_only=False)
    places = np.repeat(np.arange(len(batch.sizes)), batch.sizes)
    training = np.bincount(places, batch.counts * learnt[batch.docs], minlength=len(batch.sizes))
    training = training.astype(np.int64)

    def ask(rows: np.ndarray) -> tuple[bytes, bytes]:
        return batch.hashes[rows].tobytes(), postings.pack(training[rows])

    yield from postings.messages(postings.batch_number(sequence), batch, info, parts, ask)


def _add_counts(keys: list[bytes], notes: list[bytes]) -> list[np.ndarray]:
    """Answer requests: each token's count in all training documents."""
    if not keys:
        return []
    found = np.frombuffer(b"".join(keys), dtype=np.uint64)
    counts = [postings.unpack(n) for n in notes]
    _, place = np.unique(found, return_inverse=True)
    totals = np.bincount(place, np.concatenate(counts)).astype(np.int64)[place]
    return np.split(totals, np.cumsum([len(c) for c in counts])[:-1])


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _finish(total_tokens: int, distinct: int, unknown_room: float) -> Callable:
    room, rest = np.log10(total_tokens + distinct + 1.0), np.log10(unknown_room)

    def finish(info: pa.RecordBatch, values: np.ndarray, total: Callable) -> pa.Table:
        asked = total(np.log10(values.astype(np.float64) + 1))
        size = info.column("n_tokens").to_numpy()
        unknown = info.column("n_unknown").to_numpy()
        logs = info.column("known_logs").to_numpy() + asked
        rare = asked - unknown * rest
        return pa.table(
            [
                info.column("doc_id"), info.column("held_out"), info.column("n_tokens"),
                pa.array(size - unknown + total(values > 0).astype(np.int64)),
                pa.array(np.full(len(size), total_tokens)),
                pa.array(logs - size * room),
                pa.array(info.column("network_score").to_numpy() + rare),
            ],
            [field.split()[0] for field in _SCORES.split(", ")],
        )

    return finish


def score_documents(documents: DataFrame) -> DataFrame:
    """Score every text, learning from six sevenths of the documents."""
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_of_id(7) == 2).alias("held_out")
    )
    training = read.where("not held_out")
    vocabulary = learn_vocabulary(training)
    network = learn_network(training, vocabulary)
    shared = documents.sparkSession.sparkContext.broadcast((network, vocabulary))
    answers = postings.answered(postings.send(read, _read(shared)), _add_counts)
    finish = _finish(vocabulary.total, vocabulary.distinct, vocabulary.unknown_room)
    return postings.per_batch(answers, finish, _SCORES)


def op2(documents: DataFrame) -> DataFrame:
    return score_documents(documents)
