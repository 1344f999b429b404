"""Language identification by prediction with partial matching.

For each language a tree of byte contexts up to ``ORDER`` bytes long counts which byte
followed. A byte's code length under a language is that of method C: in a context with
``T`` observations of ``D`` distinct bytes, a byte seen ``c`` times costs
``-log2(c / (T + D))``; an unseen one costs the escape ``-log2(D / (T + D))`` and is
coded in the context one byte shorter, at last uniformly. Contexts a language has never
seen cost nothing to leave. Statistics stay as they were learnt, so the code length of
a text is the sum over its bytes, and the language with the shortest one is predicted.

Only letters tell languages apart: A-Z is lower-cased and every other ASCII byte is
read as a space, runs of which count once.

The trees are learnt from at most ``SAMPLE_DOCS`` documents per language, chosen by a
hash of their ids (see :func:`learn`); they reach the tasks as one table whose size
that bound limits. Every text is scored whole.

Defined cases: null and letterless texts are ``und`` with score 0; ties go to the first
language in order; documents without language are not learnt from; if nothing can be
learnt, all are ``und``; rows that repeat a ``doc_id`` are scored each; further columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pacefold.llm.folders import crc_of_id, stored
from pacefold.llm.text import Piece, mix, owners, pieces

#: Longest context, in bytes.
ORDER = 4
#: Documents per language that the trees are learnt from, at most.
SAMPLE_DOCS = 400
UNDETERMINED = "und"
LETTERED = "_lettered"

# What each byte is read as.
_READ = np.full(256, 0x20, dtype=np.uint8)
_READ[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_READ[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_READ[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class Letters:
    """The bytes of a piece as the trees see them, with the document of each."""

    data: np.ndarray
    docs: np.ndarray
    count: int


def letters(piece: Piece) -> Letters:
    read = _READ[piece.data]
    keep = np.ones(len(read), dtype=bool)
    keep[1:] = (read[1:] != 0x20) | (read[:-1] != 0x20)
    kept = np.flatnonzero(keep)
    return Letters(read[kept], owners(piece, kept), piece.count)


def grams(text: Letters, size: int) -> np.ndarray:
    """Each byte with the ``size - 1`` bytes before it in its document, as one number.

    Bytes before the beginning count as zero.
    """
    keys = text.data.astype(np.uint64)
    for back in range(1, size):
        earlier = np.zeros(len(keys), dtype=np.uint64)
        same = text.docs[back:] == text.docs[:-back]
        earlier[back:] = text.data[:-back] * same.astype(np.uint8)
        keys |= earlier << np.uint64(8 * back)
    return keys


class Table:
    """An open-addressed map from gram to a row of numbers, looked up in bulk."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.row = np.zeros(1 << self.bits, dtype=np.int32)
        self.rows = rows
        waiting, slots = np.arange(len(keys)), self._slots(keys)
        self.steps = 0
        while len(waiting):
            self.steps += 1
            free = waiting[self.keys[slots[waiting]] == np.iinfo(np.uint64).max]
            self.row[slots[free]] = free  # the last of several wins
            won = free[self.row[slots[free]] == free]
            self.keys[slots[won]] = keys[won]
            placed = np.zeros(len(keys), dtype=bool)
            placed[won] = True
            waiting = waiting[~placed[waiting]]
            slots[waiting] = (slots[waiting] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where it is absent."""
        slots = self._slots(keys)
        found = np.where(self.keys[slots] == keys, self.row[slots], -1)
        left = np.flatnonzero((found < 0) & (self.keys[slots] != np.iinfo(np.uint64).max))
        for _ in range(self.steps):
            if not len(left):
                break
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slots[left]]
            hit = there == keys[left]
            found[left[hit]] = self.row[slots[left[hit]]]
            left = left[~hit & (there != np.iinfo(np.uint64).max)]
        return found


@dataclass(frozen=True)
class Model:
    """Frozen trees of all languages.

    ``costs[k]`` has the code lengths of the grams of ``k + 1`` bytes that any language
    has seen; ``escapes[k]`` what leaving a context of ``k`` bytes costs each language.
    """

    languages: list[str]
    costs: list[Table]
    escapes: list[Table]

    def lengths(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code length in bits of each gram, one column per language."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8.0, dtype=np.float32)
        keys = keys & np.uint64((1 << (8 * (order + 1))) - 1)
        found = self.costs[order].find(keys)
        out = self.costs[order].rows[found]
        missing = np.flatnonzero(found < 0)
        if len(missing):
            context = self.escapes[order].find(keys[missing] >> np.uint64(8))
            left = np.where(context[:, None] < 0, np.float32(0), self.escapes[order].rows[context])
            out[missing] = left + self.lengths(keys[missing], order - 1)
        return out


def build(counts: pd.DataFrame) -> Model:
    """Trees from gram counts: columns ``lang``, ``gram`` (``ORDER + 1`` bytes), ``n``."""
    languages = sorted(counts["lang"].unique())
    which = counts["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    full = counts["gram"].to_numpy().view(np.uint64)
    seen = counts["n"].to_numpy().astype(np.float64)
    costs, escapes, lower = [], [], None
    for order in range(ORDER + 1):
        grams_seen, place = np.unique(
            full & np.uint64((1 << (8 * (order + 1))) - 1), return_inverse=True
        )
        matrix = np.zeros((len(grams_seen), len(languages)))
        np.add.at(matrix, (place, which), seen)
        contexts, context = np.unique(grams_seen >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(contexts), len(languages)))
        distinct = np.zeros_like(total)
        np.add.at(total, context, matrix)
        np.add.at(distinct, context, matrix > 0)
        room = total + distinct
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(room > 0, -np.log2(distinct / room), 0.0)
            direct = -np.log2(matrix / room[context])
        if order == 0:
            below = np.full_like(matrix, 8.0)
        else:
            shorter = grams_seen & np.uint64((1 << (8 * order)) - 1)
            below = lower[1][np.searchsorted(lower[0], shorter)]
        cost = np.where(matrix > 0, direct, leave[context] + below)
        lower = (grams_seen, cost)
        costs.append(Table(grams_seen, cost.astype(np.float32)))
        escapes.append(Table(contexts, leave.astype(np.float32)))
    return Model(languages, costs, escapes)


def learn(documents: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Count grams in a bounded sample of the documents that have a language.

    A language's sample is its ``sample_docs`` documents with the smallest hash of
    their id, or of their text if they have no id; whole texts count. Rows that repeat
    an id are one document here, and those that repeat its text count once. One row per
    document of the sample is broadcast. What comes to the driver is one row per
    language and distinct gram of that sample.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    keyed = documents.where(F.col("lang").isNotNull()).select("lang", "text", key.alias("_key"))
    sizes = keyed.groupBy(F.col("lang").alias("_of")).agg(
        F.approx_count_distinct("_key").alias("_docs")
    )
    # Only keys hashed low enough to be among the smallest are ranked: twice as many as
    # are wanted, or all, however many documents a language has.
    share = F.pmod("_key", F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = Window.partitionBy("lang").orderBy("_share", "_key")
    ranked = (
        keyed.select("lang", "_key", share.alias("_share"))
        .join(F.broadcast(sizes), F.col("lang") == F.col("_of"))
        .where(F.col("_share") * F.col("_docs") <= 2 * sample_docs)
        .select("lang", "_key", "_share")
        .distinct()
        .withColumn("_rank", F.row_number().over(chosen))
        .where(F.col("_rank") <= sample_docs)
        .select("lang", "_key")
    )
    picked = keyed.join(F.broadcast(ranked), ["lang", "_key"], "left_semi").dropDuplicates(
        ["lang", "_key", "text"]
    )
    counted = (
        picked.select("lang", "text")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    counts = counted.toArrow().to_pandas()
    return build(counts) if len(counts) else None


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), dtype=object)
        for piece in pieces(batch.column("text")):
            text = letters(piece)
            keys, owner = grams(text, ORDER + 1), languages[piece.first : piece.last][text.docs]
            for name in sorted(set(languages[piece.first : piece.last])):
                found, n = np.unique(keys[owner == name], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"],
                )


def code_lengths(model: Model, piece: Piece) -> np.ndarray:
    """Code length in bits of each document under each language."""
    text = letters(piece)
    sums = np.zeros((piece.count, len(model.languages)))
    if len(text.data):
        costs = model.lengths(grams(text, ORDER + 1))
        firsts = np.flatnonzero(np.r_[True, text.docs[1:] != text.docs[:-1]])
        sums[text.docs[firsts]] = np.add.reduceat(costs, firsts, axis=0, dtype=np.float64)
    return sums


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the languages' posterior at equal priors."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    others = [c for c in documents.columns if c not in ("lang_pred", "score")]
    schema = StructType(
        [f for f in documents.schema if f.name in others]
        + StructType.fromDDL("lang_pred string, score double").fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            names = np.full(batch.num_rows, UNDETERMINED, dtype=object)
            scores = np.zeros(batch.num_rows)
            lettered = np.array(batch.column(LETTERED).to_pylist(), dtype=bool)
            for piece in pieces(batch.column("text")) if trees else ():
                sums = code_lengths(trees, piece)
                odds = np.exp2(np.maximum(-1000, sums.min(axis=1, keepdims=True) - sums))
                names[piece.first : piece.last] = np.array(trees.languages, dtype=object)[
                    sums.argmin(axis=1)
                ]
                scores[piece.first : piece.last] = 1 / odds.sum(axis=1)
            names[~lettered], scores[~lettered] = UNDETERMINED, 0.0
            columns = [batch.column(c) for c in others] + [pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*others, "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(LETTERED)
    return documents.select(*(F.col(f"`{c}`") for c in others), lettered).mapInArrow(run, schema)


def identify(documents: DataFrame) -> DataFrame:
    """Predict the language of every document, learning from two thirds of them."""
    held_out = crc_of_id(3) == 1
    marked = documents.withColumn("held_out", held_out)
    return predict(marked, learn(documents.where(~held_out)))


def op6(documents: DataFrame) -> DataFrame:
    needed = documents.select("doc_id", "text", "lang")
    return identify(needed).select("doc_id", "held_out", "lang_pred", "score")
