"""Near-duplicate detection by MinHash.

A document's set are its distinct five-word shingles, A-Z in lower case; with fewer
words the whole sequence is its one shingle. Two documents are linked if
``100 * intersection >= percent * union``, ``percent`` being 85 unless given.

Documents with equal sets are one class and go on as its smallest id, so copies are
never expanded into pairs. One-permutation hashing puts a set's shingle hashes into
``BANDS * ROWS`` bins and keeps the smallest of each; an empty bin borrows from the
first non-empty bin on a probe sequence of its own (optimal densification). ``ROWS``
bins make a band; classes that agree on a band meet in a bucket. A pair at the
threshold misses all bands with probability ``(1 - 0.85**4)**28``, about 1e-9.

Candidate edges are star-shaped: each bucket's members go to its most connected class,
the centre, and a member shared by several buckets of one centre goes there once. All
sets of a star are compared with its centre's. Members linked with the centre are one
component already; only a *stranger*, a member that is not, can still be linked with
other members, and it is compared with those that three tests leave: their distance
(one minus similarity, a metric) to the centre must be within that of the threshold of
its own, their sizes must allow the similarity, and their finer signatures of
``FINE_BINS`` bins must not agree less than linked sets do but with a chance of 1e-12. Two
linked classes share a bucket and so a star; so a link at the threshold is lost with a
chance of about 1e-9 at 85 % (4e-7 at 80 %), by the bands, and copies of one text, the
usual large group, cost one comparison each. Stars too large for one task are cut by distance to
the centre, and a stranger goes to the parts within its reach.

Defined cases: null and wordless texts have an empty set, are linked with nothing and
kept; documents without an id likewise (their component is null); rows that repeat an
id get a row each, and if their texts differ, the id has the links of one of them, the one
with the smallest digest; a very long text is the work of one task, with some 80 bytes for
each of its bytes; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.llm.folders import Store, of_ids, stored, workspace
from pacefold.llm.text import mix, pieces, shingle_sets, signed

WIDTH = 5
PERCENT = 85
BANDS = 28
ROWS = 4
BINS = BANDS * ROWS
#: Bins of the finer signatures that keep strangers from being compared in vain.
FINE_BINS = 256
#: Shingles of a star's members that one task holds, about.
PART_SHINGLES = 1_000_000
#: Large stars are cut into rings of this width around their centre.
RING = 0.05


def _reach(percent: int) -> float:
    """How far apart linked sets are at most."""
    return 1 - percent / 100


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _probe(attempt: int, bins: int) -> np.ndarray:
    """Where each bin looks at the given attempt."""
    seeds = np.arange(bins, dtype=np.uint64) + np.uint64(attempt) * np.uint64(bins)
    return (mix(seeds + np.uint64(0x51ED270B)) % np.uint64(bins)).astype(np.int64)


def signatures(
    shingles: np.ndarray, docs: np.ndarray, count: int, bins: int = BINS
) -> np.ndarray:
    """One-permutation hashes of each document's set, densified; one row per document.

    ``shingles`` must be sorted within each document. Bins follow the order of hashes,
    so the first shingle of a bin is its smallest. Rows of empty sets stay empty.
    """
    place = ((shingles >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    slots = docs * bins + place
    first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else slots
    table = np.full(count * bins, _EMPTY, dtype=np.uint64)
    table[slots[first]] = shingles[first]
    given = table.reshape(count, bins)
    dense = given.copy()
    filled = np.bincount(docs, minlength=count) > 0
    rows, holes = np.nonzero((given == _EMPTY) & filled[:, None])
    attempt = 0
    while len(rows):
        donor = given[rows, _probe(attempt, bins)[holes]]
        dense[rows, holes] = donor
        left = donor == _EMPTY
        rows, holes = rows[left], holes[left]
        attempt += 1
    return dense


def bands(dense: np.ndarray) -> np.ndarray:
    """One hash per band of each row."""
    parts = dense.reshape(len(dense), BANDS, ROWS)
    out = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(dense), 1))
    for row in range(ROWS):
        out = mix(out + parts[:, :, row])
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for piece in pieces(batch.column("text")):
            shingles, docs = shingle_sets(piece, WIDTH)
            sizes = np.bincount(docs, minlength=piece.count)
            lanes = []
            for lane in (1, 2):  # order-free digests of the whole set
                sums = np.zeros(piece.count, dtype=np.uint64)
                np.add.at(sums, docs, mix(shingles + np.uint64(lane)))
                lanes.append(pa.array(signed(sums)))
            buckets = bands(signatures(shingles, docs, piece.count))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(piece.count + 1, dtype=np.int32) * BANDS),
                pa.array(signed(buckets.reshape(-1))),
            )
            yield pa.RecordBatch.from_arrays(
                [ids.slice(piece.first, piece.count), pa.array(sizes, pa.int64()), *lanes, lists],
                ["doc_id", "n_shingles", "digest_a", "digest_b", "buckets"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets and fine signatures, the latter one byte a bin."""
    for batch in batches:
        ids = batch.column("doc_id")
        for piece in pieces(batch.column("text")):
            shingles, docs = shingle_sets(piece, WIDTH)
            sizes = np.bincount(docs, minlength=piece.count)
            fine = mix(signatures(shingles, docs, piece.count, FINE_BINS)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(piece.first, piece.count),
                    pa.array(sizes, pa.int64()),
                    _blobs(np.cumsum(sizes) * 8, shingles),
                    _blobs(np.arange(1, piece.count + 1) * FINE_BINS, fine),
                ],
                ["rep", "n", "members", "fine"],
            )


def _blobs(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    parts = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), parts).cast(pa.binary())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and its ``root``, the smallest node of its component.

    ``edges`` has columns ``u`` and ``v``. Each round hooks every node to its smallest
    neighbour and goes on with the edges between the nodes hooked to, until none is
    left; then the rounds are followed back.
    """
    with workspace(edges.sparkSession, "components") as store:
        levels = []
        left = store(edges.select("u", "v").where("u <> v").distinct(), "edges")
        while not left.isEmpty():
            both = left.union(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
            lowest = both.groupBy("u").agg(F.min("v").alias("low"))
            hooks = store(
                lowest.select(F.col("u").alias("node"), F.least("u", "low").alias("root")), "hooks"
            )
            levels.append(hooks)
            at_u = hooks.select(F.col("node").alias("u"), F.col("root").alias("ru"))
            at_v = hooks.select(F.col("node").alias("v"), F.col("root").alias("rv"))
            moved = left.join(at_u, "u").join(at_v, "v").where("ru <> rv")
            left = store(
                moved.select(
                    F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")
                ).distinct(),
                "edges",
            )
        found = left.select(F.col("u").alias("node"), F.col("v").alias("root"))
        for hooks in reversed(levels):
            above = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = hooks.join(above, "root", "left").select(
                "node", F.coalesce("top", "root").alias("root")
            )
        return stored(found, "roots")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys; a run may span batches."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy() for k in keys]
        fresh = np.any([v[1:] != v[:-1] for v in values], axis=0)
        cuts = np.concatenate([[0], np.flatnonzero(fresh) + 1])
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(low, high - low)
        held = batch.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


class _Members:
    """Some members of a star."""

    def __init__(self, rows: pa.RecordBatch) -> None:
        self.reps = rows.column("rep").to_numpy()
        self.sets = [np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in rows.column("members")]
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        fine = [np.frombuffer(b.as_buffer(), dtype=np.uint8) for b in rows.column("fine")]
        self.fine = np.stack(fine) if fine else np.zeros((0, FINE_BINS), dtype=np.uint8)


def _shared(one: np.ndarray, other: np.ndarray) -> int:
    return np.intersect1d(one, other, assume_unique=True).size


def _linked(
    shared: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int
) -> np.ndarray:
    return 100 * shared >= percent * (one + other - shared)


#: Sizes from which on a set fills all fine bins, as good as always.
_FULL = 8 * FINE_BINS
#: Logarithm of the chance that linked sets agree on fewer fine bins than the bound.
_MISS = np.log(1e-12)


@lru_cache(maxsize=4)
def _match_bounds(percent: int) -> np.ndarray:
    """By the smaller set's size, the share of fine bins that linked sets agree on at least.

    Chernoff's bound on a binomial tail: agreement below a share q of m bins, each agreeing
    with probability p, has a chance of ``exp(-m KL(q, p))`` at most. Bins that borrow are
    no trials of their own: m is the number of independent bins with the same variance.
    """
    sizes = np.arange(_FULL + 1)
    filled = np.maximum(FINE_BINS * -np.expm1(-sizes / FINE_BINS), 1)
    trials = FINE_BINS**2 / (FINE_BINS**2 / filled + FINE_BINS - filled)
    level = percent / 100
    low, high = np.zeros(len(sizes)), np.full(len(sizes), level)
    for _ in range(50):
        q = (low + high) / 2
        apart = q * np.log(np.maximum(q, 1e-300) / level) + (1 - q) * np.log((1 - q) / (1 - level))
        sure = -trials * apart <= _MISS
        low, high = np.where(sure, q, low), np.where(sure, high, q)
    return low


def _lowest_match(sizes: np.ndarray, percent: int) -> np.ndarray:
    return _match_bounds(percent)[np.minimum(sizes, _FULL)]


def _links_of_strangers(
    strangers: _Members,
    from_centre: np.ndarray,
    members: _Members,
    distances: np.ndarray,
    percent: int,
) -> list[tuple[int, int]]:
    """Links between strangers and members of a star, by their full sets."""
    found = []
    for row, rep in enumerate(strangers.reps):
        size = strangers.sizes[row]
        low, high = np.minimum(members.sizes, size), np.maximum(members.sizes, size)
        near = np.abs(distances - from_centre[row]) <= _reach(percent) + 1e-9
        near &= (100 * low >= percent * high) & (members.reps != rep)
        rows = np.flatnonzero(near)
        match = (members.fine[rows] == strangers.fine[row]).mean(axis=1)
        for other in rows[match >= _lowest_match(low[rows], percent)]:
            both = _shared(strangers.sets[row], members.sets[other])
            if _linked(both, size, members.sizes[other], percent):
                found.append((rep, members.reps[other]))
    return found


_EDGES = "u long, v long, linked boolean, distance double, parts int"


def _edges(u, v, linked, distance, parts) -> pa.RecordBatch:
    columns = zip((u, v, linked, distance, parts), _EDGE_TYPES, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in columns], ["u", "v", "linked", "distance", "parts"]
    )


_EDGE_TYPES = (pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.int32())


def _stars(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Compare a star's members with its centre; settle stars of one part wholly."""
    for group in _groups(batches, ["centre", "part"]):
        centre, parts = group.column("centre")[0].as_py(), group.column("parts")[0].as_py()
        star = _Members(group)
        at = int(np.flatnonzero(star.reps == centre)[0])
        own, size = star.sets[at], star.sizes[at]
        shared = np.array([_shared(own, s) for s in star.sets])
        distances = 1 - shared / (star.sizes + size - shared)
        linked = _linked(shared, star.sizes, size, percent)
        others = np.flatnonzero(star.reps != centre)
        count = len(others)
        yield _edges(
            np.full(count, centre), star.reps[others], linked[others], distances[others],
            np.full(count, parts),
        )
        alone = np.flatnonzero(~linked)
        if parts == 1 and len(alone) and count > 1:
            strangers = _Members(group.take(pa.array(alone)))
            pairs = _links_of_strangers(strangers, distances[alone], star, distances, percent)
            if pairs:
                u, v = zip(*pairs, strict=True)
                yield _edges(u, v, [True] * len(u), [None] * len(u), [1] * len(u))


def _rings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Compare strangers with the members of one part of a ring."""
    for group in _groups(batches, ["centre", "ring", "part"]):
        stranger = group.column("stranger").to_numpy(zero_copy_only=False)
        distances = group.column("distance").to_numpy()
        some, rest = np.flatnonzero(stranger), np.flatnonzero(~stranger)
        pairs = _links_of_strangers(
            _Members(group.take(pa.array(some))), distances[some],
            _Members(group.take(pa.array(rest))), distances[rest], percent,
        )
        if pairs:
            u, v = zip(*pairs, strict=True)
            yield _edges(u, v, [True] * len(u), [None] * len(u), [1] * len(u))


def star_links(stars: DataFrame, sets: DataFrame, store: Store, percent: int = PERCENT) -> DataFrame:
    """Links ``u, v`` of all stars, given as ``centre, rep`` with the centre not among them."""
    sizes = sets.select("rep", "n")
    parts = store(
        stars.join(sizes, "rep")
        .groupBy("centre")
        .agg(F.ceil(F.sum("n") / PART_SHINGLES).cast("int").alias("parts")),
        "star-parts",
    )
    members = stars.join(parts, "centre").select(
        "centre", "parts", _dealt("rep", F.col("parts")).alias("part"), "rep"
    )
    centres = parts.select(
        "centre",
        "parts",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col("centre").alias("rep"),
    )
    compared = store(
        members.union(centres)
        .join(sets, "rep")
        .repartition("centre", "part")
        .sortWithinPartitions("centre", "part", "rep")
        .mapInArrow(partial(_stars, percent=percent), _EDGES),
        "compared",
    )
    links = compared.where("linked").select("u", "v")
    large = compared.where("parts > 1").select(
        F.col("u").alias("centre"), F.col("v").alias("rep"), "distance"
    )
    if large.isEmpty():
        return links
    return links.union(_links_across_parts(large, sets, store, percent))


def _dealt(column: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(column), count).cast("int")


def _links_across_parts(
    large: DataFrame, sets: DataFrame, store: Store, percent: int
) -> DataFrame:
    """Links of strangers in stars of several parts, given each member's distance."""
    reach = _reach(percent)
    placed = large.withColumn("ring", F.floor(F.col("distance") / RING).cast("int"))
    rings = store(
        placed.join(sets.select("rep", "n"), "rep")
        .groupBy("centre", "ring")
        .agg(F.ceil(F.sum("n") / PART_SHINGLES).cast("int").alias("parts")),
        "rings",
    )
    members = placed.join(rings, ["centre", "ring"]).select(
        "centre", "ring", _dealt("rep", F.col("parts")).alias("part"), "rep", "distance",
        F.lit(False).alias("stranger"),
    )
    inner, outer = F.col("ring") * RING, (F.col("ring") + 1) * RING
    strangers = (
        large.where(F.col("distance") > reach - 1e-9)
        .join(rings, "centre")
        .where((inner <= F.col("distance") + reach + 1e-6) & (outer >= F.col("distance") - reach - 1e-6))
        .select(
            "centre", "ring",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            "rep", "distance", F.lit(True).alias("stranger"),
        )
    )
    return (
        members.union(strangers)
        .join(sets, "rep")
        .repartition("centre", "ring", "part")
        .sortWithinPartitions("centre", "ring", "part")
        .mapInArrow(partial(_rings, percent=percent), _EDGES)
        .select("u", "v")
    )


def classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, n_shingles, rep``, and the bands of each non-empty class."""
    sketches = stored(
        documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            _sketch,
            "doc_id long, n_shingles long, digest_a long, digest_b long, buckets array<long>",
        ),
        "sketches",
    )
    key = ["digest_a", "digest_b", "n_shingles"]
    usable = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    smallest = stored(usable.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    members = stored(
        usable.select("doc_id", *key).join(smallest, key).select("doc_id", "n_shingles", "rep"),
        "members",
    )
    rest = sketches.where((F.col("n_shingles") == 0) | F.col("doc_id").isNull())
    every = members.unionByName(
        rest.select("doc_id", "n_shingles", F.col("doc_id").alias("rep"))
    )
    firsts = usable.select("doc_id", "n_shingles", "buckets", *key[:2]).join(
        smallest.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi"
    )
    firsts = firsts.select(F.col("doc_id").alias("rep"), "n_shingles", "buckets")
    return every, firsts.dropDuplicates(["rep"])


def star_edges(firsts: DataFrame, store: Store) -> DataFrame:
    """Distinct ``centre, rep`` of all buckets with more than one class.

    A bucket's centre is the class that meets most others over all its buckets.
    """
    rows = firsts.select(F.explode("buckets").alias("bucket"), "rep")
    several = rows.groupBy("bucket").agg(F.count("*").alias("met")).where("met > 1")
    buckets = store(rows.join(several, "bucket"), "buckets")
    connected = buckets.groupBy("rep").agg((-F.sum("met")).alias("rank"))
    ranked = store(buckets.join(connected, "rep").select("bucket", "rank", "rep"), "ranked")
    highest = ranked.groupBy("bucket").agg(F.min("rank").alias("rank"))
    centres = (
        ranked.join(highest, ["bucket", "rank"])
        .groupBy("bucket")
        .agg(F.min("rep").alias("centre"))
    )
    return store(
        ranked.join(centres, "bucket").where("rep <> centre").select("centre", "rep").distinct(),
        "stars",
    )


def link_classes(firsts: DataFrame, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``node, root`` of every class that is linked with another."""
    with workspace(documents.sparkSession, "links") as store:
        stars = star_edges(firsts, store)
        active = stars.select(F.col("rep").alias("doc_id")).union(stars.select("centre")).distinct()
        texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        sets = store(
            of_ids(texts, store(active, "active"), "doc_id").mapInArrow(
                _sets, "rep long, n long, members binary, fine binary"
            ),
            "sets",
        )
        return components(star_links(stars, sets, store, percent))


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``documents``.

    Documents are linked from a similarity of ``percent`` hundredths on. The bands miss a
    pair at 80 with a chance of 4e-7, and more below.
    """
    members, firsts = classes(documents)
    roots = link_classes(firsts, documents, percent)
    component = F.coalesce("root", "rep")
    return members.join(roots, F.col("rep") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op5(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents.select("doc_id", "text"))
