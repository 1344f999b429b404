"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Each vector is scaled to length 1, embedded by a fixed random orthonormal map into
``BITS`` dimensions, and kept as the signs of its coordinates, packed into bits, with
one correction scalar: the inner product of the vector with its own code. A query's
inner product with a vector is estimated from the packed bits as (query . code) /
correction, with an error that is at most

    SIGMAS * sqrt((1 - correction^2) / correction^2 / (BITS - 1))

with high probability. In every tile of queries and codes, the vectors whose upper
bound reaches the query's ``k``-th best so far are ranked again by their exact cosine;
all others are left out. The map depends on no data, every vector has a code, and
queries and vectors meet in blocks of bounded size.

Equal vectors are one class: it is searched once, and its smallest ids stand for it, as
ties go to smaller ids. So copies of a vector never meet as pairs.

Defined cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows without an id; vectors are compared with those of equal length
only; rows that repeat an id with the same vector count once; a query with fewer
candidates has fewer rows; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacefold.llm.folders import stored

#: Bits of a code; vectors longer than this get as many bits as they have components.
BITS = 256
#: Width of the error bound.
SIGMAS = 2.5
#: Neighbours returned, and the ids that are queries.
NEIGHBOURS = 5
QUERY_EVERY = 50
#: Vectors and queries of a block, about.
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 2_048
#: Codes and queries estimated at once within a block.
TILE_CODES, TILE_QUERIES = 2_048, 256


def rotation(size: int) -> np.ndarray:
    """A fixed random map with orthonormal columns, ``max(BITS, size)`` by ``size``."""
    pick = np.random.default_rng(20_240_501 + size)
    tall, wide = np.linalg.qr(pick.normal(size=(max(BITS, size), size)))
    return tall * np.sign(np.diag(wide))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction scalars of unit vectors."""
    turned = vectors @ rotation(vectors.shape[1]).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (vectors @ query) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of a batch; the vectors of a batch may differ in length."""
    for batch in batches:
        lengths = batch.column("embedding").value_lengths().to_numpy()
        for length in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == length))
            codes, corrections = encode(unit(_matrix(rows.column("embedding"))))
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(corrections),
                ],
                [*rows.schema.names, "code", "correction"],
            )


def _search(left: pa.Table, right: pa.Table) -> pa.Table:
    """The nearest classes of a block to each query of a block, by exact cosine."""
    out = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])
    if not left.num_rows or not right.num_rows:
        return out.empty_table()
    k = NEIGHBOURS + 1  # a query's own class may be among them
    left, right = left.sort_by("rep"), right.sort_by("query")
    reps, vectors = left["rep"].to_numpy(), _matrix(left["embedding"])
    codes = np.frombuffer(b"".join(left["code"].to_pylist()), dtype=np.uint8).reshape(len(reps), -1)
    corrections = left["correction"].to_numpy()
    names, queries = right["query"].to_numpy(), _matrix(right["embedding"])
    turned = (unit(queries) @ rotation(queries.shape[1]).T).astype(np.float32)
    width = turned.shape[1]
    error = SIGMAS * np.sqrt((1 - corrections**2).clip(0) / corrections**2 / max(1, width - 1))
    best = [(np.zeros(0), np.zeros(0, dtype=np.int64)) for _ in names]
    floor = np.full(len(names), -np.inf)
    for low in range(0, len(reps), TILE_CODES):
        tile = slice(low, low + TILE_CODES)
        signs = np.unpackbits(codes[tile], axis=1, count=width).astype(np.float32) * 2 - 1
        signs /= np.float32(np.sqrt(width))
        for first in range(0, len(names), TILE_QUERIES):
            some = slice(first, first + TILE_QUERIES)
            estimate = (turned[some] @ signs.T) / corrections[tile].astype(np.float32)
            lower = estimate - error[tile]
            if lower.shape[1] > k:
                kth = np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k]
                floor[some] = np.maximum(floor[some], kth)
            # A score may round below its bound by the last digits of a float.
            near = estimate + error[tile] >= floor[some, None] - 1e-6
            for row in np.flatnonzero(near.any(axis=1)):
                chosen = low + np.flatnonzero(near[row])
                query = first + row
                scores = np.concatenate([best[query][0], cosines(queries[query], vectors[chosen])])
                found = np.concatenate([best[query][1], chosen])
                order = np.lexsort((reps[found], -scores))[:k]
                best[query] = scores[order], found[order]
                if len(order) == k:
                    floor[query] = max(floor[query], scores[order[-1]])
    counts = [len(s) for s, _ in best]
    return pa.table(
        [
            pa.array(np.repeat(names, counts)),
            pa.array(reps[np.concatenate([f for _, f in best])]),
            pa.array(np.concatenate([s for s, _ in best])),
        ],
        schema=out,
    )


def _usable(embeddings: DataFrame) -> DataFrame:
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & vector.isNotNull())
        .where(F.coalesce(finite, F.lit(False)))
        .where(F.coalesce(some, F.lit(False)))
    )


def nearest(embeddings: DataFrame) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's nearest, best first."""
    usable = _usable(embeddings).distinct()
    first = Window.partitionBy("embedding").orderBy("vec_id")
    # One member more than neighbours, as a query leaves itself out.
    members = (
        usable.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= NEIGHBOURS + 1)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    classes = stored(
        members.select("embedding", "rep", "ids").mapInArrow(
            _encode_rows,
            f"embedding {_type(embeddings)}, rep long, ids array<long>, code binary, correction double",
        ),
        "vector-classes",
    )
    queries = stored(
        usable.where(F.col("vec_id") % QUERY_EVERY == 0)
        .join(classes.select("embedding", "rep"), "embedding")
        .select("vec_id", "rep"),
        "query-classes",
    )
    asked = stored(
        queries.select("rep")
        .distinct()
        .join(classes, "rep")
        .select(F.col("rep").alias("query"), "embedding"),
        "query-vectors",
    )
    blocks = max(1, -(-classes.count() // BLOCK_VECTORS))
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    length = F.size("embedding").alias("length")

    def dealt(column: str, count: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = classes.select(
        "rep", "embedding", "code", "correction", length,
        dealt("rep", blocks).alias("block"), every(query_blocks).alias("query_block"),
    )
    right = asked.select(
        "query", "embedding", length,
        dealt("query", query_blocks).alias("query_block"), every(blocks).alias("block"),
    )
    key = ["length", "block", "query_block"]
    found = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInArrow(_search, "query long, rep long, score double")
    )
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "rep")
    classes_found = (
        found.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= NEIGHBOURS + 1)
        .join(classes.select("rep", "ids"), "rep")
        .select("query", "score", "ids")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        queries.withColumnsRenamed({"vec_id": "query_id", "rep": "query"})
        .join(classes_found, "query")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= NEIGHBOURS)
        .select("query_id", "rank", "vec_id", "score")
    )


def _type(embeddings: DataFrame) -> str:
    return embeddings.schema["embedding"].dataType.simpleString()


def op7(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings)
