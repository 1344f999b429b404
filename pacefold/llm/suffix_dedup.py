"""Removing passages that repeat earlier text, by a depth-limited radix sort of suffixes.

A byte goes if a string of ``DEPTH`` bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in the same document. Suffixes are ordered by
their first ``DEPTH`` bytes only; suffixes that are equal to that depth are exactly the
repeated windows, and all but the first of such a group are repeats.

A corpus has as many suffixes as bytes, so they move in runs. The most significant
digit of a suffix is the one of its ``DIGIT``-byte strings (among those that start in
its first ``DEPTH - DIGIT + 1`` bytes) with the smallest hash. Equal suffixes have equal
digits at equal offsets, and neighbouring suffixes mostly share one, so one row stands
for some 33 suffixes. The passes, each of which keeps what is not alone in its group:

1. by digit, and by the text that the whole run spans. Runs equal as a whole are
   settled here. Each map task settles its own first, so a passage that a third of all
   documents share sends one row per task, not one per document.
2. runs that share the digit but differ elsewhere are cut in two, suffixes that hold
   the ``NEXT`` bytes before the digit and suffixes that hold those behind it, and
   grouped by these as the next digit.
3. those still together are ordered suffix by suffix to the full depth.

Groups are told apart by 64-bit hashes of their strings, two at a time.

Defined cases: null text is empty; texts shorter than ``DEPTH`` are left alone;
documents without an id take no part; of rows that repeat an id, equal texts are one
document (the same text under one id does not repeat itself) and different ones are
documents of their own, in the order of a hash of their texts, and each row is cut; a very
long text is the work of one task, with some 80 bytes for each of its bytes; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pacefold.llm.folders import partitions, stored
from pacefold.llm.text import Piece, give_back, mix, owners, pieces, prefix_sums, runs, signed, span_hashes

#: Bytes of the strings that must repeat.
DEPTH = 100
#: Bytes of the most significant digit, and of the next.
DIGIT = 36
NEXT = 32
#: Runs a map task gathers before it settles and sends them.
GATHER = 250_000
#: Groups of digits per shuffle partition.
SPREAD = 2

#: ``copy`` tells texts under one id apart; 0 where an id has one text, and compresses well.
_RUN = [("digit", "<u8"), ("span", "<u8"), ("doc", "<i8"), ("copy", "<i8"), ("start", "<i8"), ("count", "<i4"), ("back", "<i4")]
_RUN_COLUMNS = [name for name, _ in _RUN]
_RUN_SCHEMA = "part int, kind int, digit binary, span binary, doc binary, copy binary, start binary, count binary, back binary"
_RANGES = "doc long, copy long, start long, count int"


def _smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def suffix_runs(piece: Piece) -> dict[str, np.ndarray] | None:
    """Runs of neighbouring suffixes with the same most significant digit.

    ``start`` (in the piece) and ``count`` give the suffixes of a run, ``back`` how far
    the digit begins behind the first of them, ``span`` the hash of all text that they
    cover to the depth.
    """
    size = len(piece.data)
    if size < DEPTH:
        return None
    sums = prefix_sums(piece.data)
    at = np.arange(size - DIGIT + 1)
    digits = span_hashes(sums, at, at + DIGIT)
    places = np.uint64((1 << size.bit_length()) - 1)
    packed = (digits & ~places) | at.astype(np.uint64)
    chosen = (_smallest_in_windows(packed, DEPTH - DIGIT + 1) & places).astype(np.int64)
    crossing = np.zeros(size + 1, dtype=np.int32)
    edges = np.unique(piece.offsets[1:-1])
    np.add.at(crossing, np.maximum(edges - DEPTH + 1, 0), 1)
    np.add.at(crossing, edges, -1)
    whole = np.cumsum(crossing)[: len(chosen)] == 0
    fresh = np.ones(len(chosen), dtype=bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | ~whole[:-1]
    last = np.ones(len(chosen), dtype=bool)
    last[:-1] = fresh[1:] | ~whole[1:]
    starts, ends = np.flatnonzero(whole & fresh), np.flatnonzero(whole & last) + 1
    count, back = ends - starts, chosen[starts] - starts
    span = span_hashes(sums, starts, ends - 1 + DEPTH) ^ mix((back * DEPTH + count).astype(np.uint64))
    return {
        "digit": digits[chosen[starts]], "span": span, "start": starts,
        "count": count, "back": back,
    }


def _grouped(run: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Runs sorted by digit, text and place; where a new digit, where a new text begins."""
    order = np.lexsort((run["start"], run["copy"], run["doc"], run["span"], run["digit"]))
    run = {name: values[order] for name, values in run.items()}
    new_digit = np.ones(len(order), dtype=bool)
    new_digit[1:] = run["digit"][1:] != run["digit"][:-1]
    new_text = new_digit.copy()
    new_text[1:] |= run["span"][1:] != run["span"][:-1]
    return run, new_digit, new_text


def _repeats(run: dict[str, np.ndarray], new_text: np.ndarray) -> np.ndarray:
    """Which sorted runs repeat one that starts earlier (rows of one place do not)."""
    first = np.flatnonzero(new_text)
    of = first[np.cumsum(new_text) - 1]
    return np.any([run[name] != run[name][of] for name in ("doc", "copy", "start")], axis=0)


def _take(run: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {name: values[rows] for name, values in run.items()}


def _packed(run: dict[str, np.ndarray], part: np.ndarray, kind: int) -> pa.RecordBatch:
    """One row per part, its runs as plain arrays in order of place."""
    order = np.lexsort((run["start"], run["copy"], run["doc"], part))
    part = part[order]
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
    ends = np.r_[cuts[1:], len(part)].astype(np.int64)
    arrays = [pa.array(part[cuts], pa.int32()), pa.array(np.full(len(cuts), kind, dtype=np.int32))]
    for name, dtype in _RUN:
        values = np.ascontiguousarray(run[name][order].astype(dtype))
        offsets = np.r_[cuts, ends[-1:]].astype(np.int32) * values.itemsize
        arrays.append(
            pa.Array.from_buffers(
                pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(values)]
            )
        )
    return pa.RecordBatch.from_arrays(arrays, ["part", "kind", *_RUN_COLUMNS])


def _unpacked(table: pa.Table, kind: int) -> dict[str, np.ndarray]:
    rows = table.filter(pc.equal(table["kind"], kind))
    return {
        name: np.frombuffer(b"".join(rows[name].to_pylist()), dtype=dtype) for name, dtype in _RUN
    }


_SORT, _SETTLED = 0, 1


def _first_pass(parts: int) -> Callable:
    def send(gathered: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        run = {name: np.concatenate([g[name] for g in gathered]) for name in gathered[0]}
        gathered.clear()
        run, _, new_text = _grouped(run)
        again = _repeats(run, new_text)
        for rows, kind in ((~again, _SORT), (again, _SETTLED)):
            kept = _take(run, np.flatnonzero(rows))
            if len(kept["doc"]):
                # What is settled need not meet what it repeats: it is dealt by document.
                key = kept["digit"] if kind == _SORT else mix(kept["doc"].astype(np.uint64))
                yield _packed(kept, (key % np.uint64(parts)).astype(np.int32), kind)
        del run, kept, key, again, rows, new_text
        give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, rows = [], 0
        for batch in batches:
            ids, copies = (batch.column(c).to_numpy() for c in ("doc_id", "copy"))
            for piece in pieces(batch.column("text")):
                found = suffix_runs(piece)
                if found is None:
                    continue
                docs = owners(piece, found["start"])
                found["doc"], found["copy"] = ids[piece.first + docs], copies[piece.first + docs]
                found["start"] = found["start"] - piece.offsets[docs]
                gathered.append(found)
                rows += len(docs)
                if rows >= GATHER:
                    yield from send(gathered)
                    gathered, rows = [], 0
        if rows:
            yield from send(gathered)

    return run


def _second_pass(table: pa.Table) -> pa.Table:
    """Settle runs that are equal as a whole; name those that share only the digit."""
    settled = _unpacked(table, _SETTLED)
    run, new_digit, new_text = _grouped(_unpacked(table, _SORT))
    again = _repeats(run, new_text)
    if len(new_digit):
        group = np.cumsum(new_digit) - 1
        several = np.bincount(group, weights=new_text) > 1
        unsettled = new_text & several[group]
    else:
        unsettled = new_text
    out = [
        (settled, np.arange(len(settled["doc"])), _SETTLED),
        (run, np.flatnonzero(again), _SETTLED),
        (run, np.flatnonzero(unsettled), _SORT),
    ]
    columns = {name: np.concatenate([r[name][rows] for r, rows, _ in out]) for name in ("doc", "copy", "start", "count", "back", "digit")}
    kinds = np.concatenate([np.full(len(rows), kind, dtype=np.int32) for _, rows, kind in out])
    return pa.table(
        [
            pa.array(kinds), pa.array(columns["doc"]), pa.array(columns["copy"]), pa.array(columns["start"]),
            pa.array(columns["count"]), pa.array(columns["back"]), pa.array(signed(columns["digit"])),
        ],
        ["kind", "doc", "copy", "start", "count", "back", "digit"],
    )


def _lists(batch: pa.RecordBatch, name: str, piece: Piece) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The structs that a piece's documents list, and the document of each."""
    lists = batch.column(name).slice(piece.first, piece.count)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    fields = {f.name: flat.field(i).to_numpy() for i, f in enumerate(flat.type)}
    return np.repeat(np.arange(piece.count), sizes), fields


def _cut_runs(parts: int) -> Callable:
    """Cut unsettled runs by which next digit their suffixes hold; send their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies = batch.column("doc_id").to_numpy(), batch.column("copy").to_numpy()
            for piece in pieces(batch.column("text")):
                doc, todo = _lists(batch, "todo", piece)
                base = piece.offsets[doc] + todo["start"]
                sums = prefix_sums(piece.data)
                # Suffixes up to the cut hold the bytes before the digit.
                cut = np.clip(todo["back"] - NEXT + 1, 0, todo["count"])
                digit_at = base + todo["back"]
                for side, low, high in ((1, np.zeros_like(cut), cut), (2, cut, todo["count"])):
                    some = np.flatnonzero(high > low)
                    near = digit_at[some] - NEXT if side == 1 else digit_at[some] + DIGIT
                    key = span_hashes(sums, near, near + NEXT) + np.uint64(side)
                    key = mix(key ^ todo["digit"][some].view(np.uint64))
                    first, count = base[some] + low[some], (high - low)[some]
                    length = count + DEPTH - 1
                    span = span_hashes(sums, first, first + length)
                    span ^= mix(((todo["back"] - low)[some] * DEPTH + count).astype(np.uint64))
                    offsets = np.r_[0, np.cumsum(length)].astype(np.int64)
                    take = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], length)
                    texts = pa.Array.from_buffers(
                        pa.large_binary(), len(some),
                        [None, pa.py_buffer(offsets), pa.py_buffer(piece.data[take])],
                    ).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((key % np.uint64(parts)).astype(np.int32)),
                            pa.array(signed(key)), pa.array(signed(span)),
                            pa.array(ids[piece.first + doc[some]]), pa.array(copies[piece.first + doc[some]]),
                            pa.array(todo["start"][some] + low[some]),
                            pa.array(count.astype(np.int32)), texts,
                        ],
                        ["part", "digit", "span", "doc", "copy", "start", "count", "string"],
                    )

    return run


def _last_pass(table: pa.Table) -> pa.Table:
    """Settle equal cut runs, then order the suffixes of the rest to the full depth."""
    run = {
        name: table[name].to_numpy() for name in ("doc", "copy", "start", "count")
    } | {name: table[name].to_numpy().view(np.uint64) for name in ("digit", "span")}
    run["row"] = np.arange(table.num_rows)
    run, new_digit, new_text = _grouped(run)
    again = np.flatnonzero(_repeats(run, new_text))
    group = np.cumsum(new_digit) - 1
    several = np.bincount(group, weights=new_text) > 1
    rest = _take(run, np.flatnonzero(new_text & several[group]))
    found = [tuple(run[name][again] for name in ("doc", "copy", "start", "count"))]
    if len(rest["doc"]):
        strings = table["string"].take(pa.array(rest["row"])).combine_chunks()
        raw = strings.buffers()
        offsets = np.frombuffer(raw[1], dtype=np.int32)[: len(strings) + 1].astype(np.int64)
        sums = prefix_sums(np.frombuffer(raw[2], dtype=np.uint8)[: offsets[-1]])
        of = np.repeat(np.arange(len(strings)), rest["count"])
        step = np.arange(len(of)) - np.repeat(np.cumsum(rest["count"]) - rest["count"], rest["count"])
        at = offsets[of] + step
        suffix = {
            "digit": rest["digit"][of], "span": span_hashes(sums, at, at + DEPTH),
            "doc": rest["doc"][of], "copy": rest["copy"][of], "start": rest["start"][of] + step, "of": of,
        }
        suffix, _, new_text = _grouped(suffix)
        late = _take(suffix, np.flatnonzero(_repeats(suffix, new_text)))
        order = np.lexsort((late["start"], late["of"]))
        late = _take(late, order)
        if len(order):
            begins = np.r_[True, (np.diff(late["start"]) != 1) | (np.diff(late["of"]) != 0)]
            cuts = np.flatnonzero(begins)
            lengths = np.diff(np.r_[cuts, len(order)])
            found.append((late["doc"][cuts], late["copy"][cuts], late["start"][cuts], lengths))
    doc, copy, start, count = (np.concatenate(values) for values in zip(*found, strict=True))
    return pa.table(
        [*(pa.array(c, pa.int64()) for c in (doc, copy, start)), pa.array(count, pa.int32())],
        ["doc", "copy", "start", "count"],
    )


#: Slots of hashed ids that are looked up when texts under one id are told apart.
ID_SLOTS = 1 << 21


def with_copies(documents: DataFrame) -> DataFrame:
    """Rows of ``doc_id, text, ...`` with ``copy``, which tells texts under one id apart.

    Only ids with different texts need one. Their hashed slots, ``ID_SLOTS`` numbers at
    most, are sent to all executors; other ids in a slot get one to no harm.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    several = (
        documents.select("doc_id", text.alias("hash"))
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("hash") != F.max("hash")).alias("differ"))
        .where("differ")
        .select(slot.alias("slot"), F.lit(True).alias("differ"))
        .distinct()
    )
    marked = documents.withColumn("slot", slot).join(F.broadcast(several), "slot", "left")
    copy = F.when(F.col("differ"), text).otherwise(F.lit(0).cast("long"))
    return marked.withColumn("copy", copy).drop("slot", "differ")


def repeated_suffixes(documents: DataFrame) -> DataFrame:
    """``doc, copy, start, count``: runs of suffixes whose first ``DEPTH`` bytes start earlier.

    ``documents`` has ``doc_id`` (long, not null), ``copy`` and ``text``.
    """
    parts = SPREAD * partitions(documents.sparkSession)
    sent = documents.mapInArrow(_first_pass(parts), _RUN_SCHEMA)
    ordered = stored(
        sent.groupBy("part").applyInArrow(
            _second_pass, "kind int, doc long, copy long, start long, count int, back int, digit long"
        ),
        "suffix-runs",
    )
    todo = (
        ordered.where(F.col("kind") == _SORT)
        .groupBy(F.col("doc").alias("doc_id"), "copy")
        .agg(F.collect_list(F.struct("start", "count", "back", "digit")).alias("todo"))
    )
    rest = (
        documents.join(todo, ["doc_id", "copy"])
        .mapInArrow(
            _cut_runs(parts),
            "part int, digit long, span long, doc long, copy long, start long, count int, string binary",
        )
        .groupBy("part")
        .applyInArrow(_last_pass, _RANGES)
    )
    settled = ordered.where(F.col("kind") == _SETTLED).select("doc", "copy", "start", "count")
    return settled.unionByName(rest)


#: What :func:`remove_repeats` adds.
_RESULT = "n_bytes long, n_removed long, n_spans long, kept_text string, kept_sha256 string"
_RESULT_COLUMNS = [field.split()[0] for field in _RESULT.split(", ")]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("row")
        for piece in pieces(batch.column("text")):
            doc, found = _lists(batch, "found", piece)
            edges = np.zeros(len(piece.data) + 1, dtype=np.int32)
            begin = piece.offsets[doc] + found["start"]
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + found["count"] + DEPTH - 1, -1)
            gone = np.cumsum(edges[:-1]) > 0
            kept = np.r_[0, np.cumsum(~gone)][piece.offsets]
            left = piece.data[~gone].tobytes()
            texts = [left[a:b] for a, b in zip(kept[:-1], kept[1:], strict=True)]
            begun = owners(piece, runs(gone, piece.offsets)[0])
            sizes = np.diff(piece.offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.slice(piece.first, piece.count),
                    pa.array(sizes), pa.array(sizes - np.diff(kept)),
                    pa.array(np.bincount(begun, minlength=piece.count), pa.int64()),
                    pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                ["row", *_RESULT_COLUMNS],
            )


def cut_documents(documents: DataFrame) -> DataFrame:
    """``row``, all columns of a document but ``text``, with sizes, what is kept and its digest.

    ``kept_text`` leaves out characters that were cut in the middle; ``kept_sha256``
    is of all bytes kept. As fields of ``row`` the document's columns clash with nothing.
    """
    others = [c for c in documents.columns if c != "text"]
    read = with_copies(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text",
            F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"),
        )
    )
    found = (
        repeated_suffixes(read.where(F.col("doc_id").isNotNull()).select("doc_id", "copy", "text"))
        .groupBy(F.col("doc").alias("doc_id"), "copy")
        .agg(F.collect_list(F.struct("start", "count")).alias("found"))
    )
    nothing = F.array().cast("array<struct<start:bigint,count:int>>")
    return (
        read.join(found, ["doc_id", "copy"], "left")
        .select("row", "text", F.coalesce("found", nothing).alias("found"))
        .mapInArrow(_remove, StructType([read.schema["row"], *StructType.fromDDL(_RESULT).fields]))
    )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Documents without ``text``, with the columns of :func:`cut_documents`.

    Columns of the added names are replaced.
    """
    others = [c for c in documents.columns if c not in (*_RESULT_COLUMNS, "text")]
    return cut_documents(documents).select(*(F.col(f"row.`{c}`") for c in others), *_RESULT_COLUMNS)


def op9(documents: DataFrame) -> DataFrame:
    ids = F.col("doc_id").cast("long").alias("doc_id")
    return remove_repeats(documents.select(ids, "text")).drop("kept_text")
