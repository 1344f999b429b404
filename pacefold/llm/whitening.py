"""Whitening embeddings: projections on leading components, each scaled to variance 1.

Every entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``. Three passes over the
vectors, each a sum that every task forms of its own rows first:

1. number of vectors and exact sum of each dimension;
2. covariance, of entries centred on the integer next to the mean before they are
   multiplied: products of small integers, whose sums are exact and the same in any order.
   What the centre lacks of the mean is a correction of one rank;
3. covariance of the whitened rows, which must be the identity, and the rows themselves.

Between them the driver finds the leading eigenpairs of the covariance by slicing its
spectrum (``spectrum.py``): LDL^T inertia counts isolate each eigenvalue, Rayleigh
quotient iteration converges to it, counts certify its number. Only numbers that depend
on the dimension reach the driver: d sums and d (d + 1) / 2 products for vectors of d
entries. The work there is some ten counts of d^3 / 3 steps a component.

Defined cases: vectors that are null, empty, or hold null or non-finite entries take no
part, nor do those with an entry beyond 2^56, whose sums would leave the range of longs;
vectors of different lengths are whitened among their own length (few lengths are
assumed: each has its model on the driver); rows that repeat an id, or have none, count
and are returned each; components without variance (equal vectors; fewer vectors than
dimensions) have no unit length to be scaled to and are left out, so equal vectors alone
give no rows; a deviation beyond the range of longs is null; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacefold.llm.spectrum import leading

#: Components returned, at most.
COMPONENTS = 32
#: Integer of an entry: floor(STEPS * c) + ORIGIN.
STEPS, ORIGIN = 64, 1_000_000
_MOST = float(1 << 56)
#: Components with less of the whole variance than this have none beyond rounding.
_LEAST_SHARE = 1e-14

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


@dataclass(frozen=True)
class Model:
    """What the rows of one length need: exact sums, and the scaled components."""

    count: int
    sums: np.ndarray  # Python integers
    centre: np.ndarray  # the integers next to the means
    rest: np.ndarray  # means less centre
    maps: np.ndarray  # dimensions by components: unit vectors over sqrt(eigenvalue)
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.rest) @ self.maps

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n x - S)^2``."""
        furthest = int(np.abs(x - self.centre).max(initial=0)) + 1
        if (self.count * furthest) ** 2 * x.shape[1] < 1 << 62:
            fraction = (self.count * self.centre.astype(object) - self.sums).astype(np.int64)
            apart = self.count * (x - self.centre) + fraction
            return (apart * apart).sum(axis=1).tolist()
        apart = self.count * x.astype(object) - self.sums
        return [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part, as doubles."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    # NaN is greater than any number to Spark.
    return rows.where(
        (F.size("embedding") > 0) & F.forall("embedding", lambda c: F.coalesce(F.abs(c) < _MOST, F.lit(False)))
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of each length, and their integers."""
    lengths = batch.column("embedding").value_lengths().to_numpy()
    for length in np.unique(lengths):
        rows = batch.filter(pa.array(lengths == length))
        entries = rows.column("embedding").flatten().to_numpy().reshape(-1, length)
        yield rows, np.floor(STEPS * entries).astype(np.int64) + ORIGIN


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for _, x in _matrices(batch):
            small = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
            total = (x if small else x.astype(object)).sum(axis=0).astype(object)
            count, before = sums.get(x.shape[1], (0, 0))
            sums[x.shape[1]] = [count + len(x), before + total]
    for length, (count, total) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([length] * length, pa.int32()), pa.array(np.arange(length, dtype=np.int32)),
                pa.array([count] * length, pa.int64()), pa.array(total.tolist(), pa.decimal128(38, 0)),
            ],
            ["length", "i", "n", "total"],
        )


def _products(length: int, matrix: np.ndarray) -> pa.RecordBatch:
    """The upper half of a symmetric matrix, one row per entry."""
    i, j = np.triu_indices(len(matrix))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(i), length, dtype=np.int32)), pa.array(i.astype(np.int32)),
            pa.array(j.astype(np.int32)), pa.array(matrix[i, j]),
        ],
        ["length", "i", "j", "value"],
    )


_PRODUCTS = "length int, i int, j int, value double"


def _moments(vectors: DataFrame, read: Callable[[np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Sums of products of the rows that ``read`` makes of the integers, per length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                rows = read(x)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + rows.T @ rows
        for length, matrix in sums.items():
            yield _products(length, matrix)

    whole = vectors.mapInArrow(run, _PRODUCTS).groupBy("length", "i", "j")
    out: dict[int, list] = {}
    for length, i, j, value in whole.agg(F.sum("value")).collect():
        out.setdefault(length, []).append((i, j, value))
    return {length: _symmetric(entries) for length, entries in out.items()}


def _symmetric(entries: list[tuple[int, int, float]]) -> np.ndarray:
    i, j, values = (np.array(c) for c in zip(*entries, strict=True))
    matrix = np.zeros((i.max() + 1, i.max() + 1))
    matrix[i, j] = matrix[j, i] = values
    return matrix


def models(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The model of each length of vector."""
    totals = vectors.mapInArrow(_sum_rows, "length int, i int, n long, total decimal(38,0)")
    rows = totals.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    counts = {r.length: int(r.n) for r in rows}
    sums = {length: np.zeros(length, dtype=object) for length in counts}
    for r in rows:
        sums[r.length][r.i] = int(r.total)
    centres = {length: np.array([(2 * s + n) // (2 * n) for s in sums[length]], dtype=np.int64) for length, n in counts.items()}
    products = _moments(vectors, lambda x: (x - centres[x.shape[1]]).astype(np.float64))
    return {
        length: _model(n, sums[length], centres[length], products[length], components)
        for length, n in counts.items()
    }


def _model(n: int, sums: np.ndarray, centre: np.ndarray, products: np.ndarray, components: int) -> Model:
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre, strict=True)])
    covariance = products / n - np.outer(rest, rest)
    trace = float(np.trace(covariance))
    if trace <= 0.0:
        return Model(n, sums, centre, rest, np.zeros((len(centre), 0)), np.zeros(0))
    values, vectors = leading(covariance, components)
    some = values > _LEAST_SHARE * trace
    return Model(n, sums, centre, rest, vectors[some].T / np.sqrt(values[some]), values[some] / trace)


def identity_error(vectors: DataFrame, fitted: dict[int, Model]) -> dict[int, float]:
    """Largest entry of the whitened rows' covariance less the identity, per length."""

    def read(x: np.ndarray) -> np.ndarray:
        rows = fitted[x.shape[1]].whiten(x)
        return np.hstack([rows, np.ones((len(rows), 1))])  # the last column sums the rows

    out = {}
    for length, products in _moments(vectors, read).items():
        products = products / fitted[length].count
        mean = products[:-1, -1]
        off = products[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))
        out[length] = float(np.abs(off).max(initial=0.0))
    return out


def _whiten(fitted: dict[int, Model], errors: dict[int, float]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch):
                model = fitted[x.shape[1]]
                white = model.whiten(x)
                many, size = white.shape
                if not size:
                    continue
                row = pa.array(np.repeat(np.arange(many), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id").take(row),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), many)),
                        pa.array(np.full(many * size, model.count)),
                        pa.array(model.deviations(x), pa.int64()).take(row),
                        pa.array(white.ravel()),
                        pa.array(np.tile(model.explained, many)),
                        pa.array(np.full(many * size, errors[x.shape[1]])),
                    ],
                    [field.split()[0] for field in RESULT.split(", ")],
                )

    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, see ``RESULT``."""
    vectors = usable(embeddings)
    fitted = models(vectors, components)
    return vectors.mapInArrow(_whiten(fitted, identity_error(vectors, fitted)), RESULT)


def op12(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)
