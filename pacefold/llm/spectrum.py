"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

How many eigenvalues lie above a shift is the number of positive pivots of the shifted
matrix's LDL^T factors (Sylvester's law of inertia). Such counts cut the spectrum into
intervals that hold one eigenvalue each. Rayleigh quotient iteration then converges
cubically to it, and two more counts, just below and just above the value found,
certify which one it is. Eigenvalues that no shift can tell apart are one cluster, whose
vectors are found one after another, each at right angles to those before.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
#: Bunch and Kaufman's bound, which keeps the factors from growing.
_ALPHA = (1 + 17**0.5) / 8


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: positive pivots of LDL^T of the shifted matrix.

    Symmetric pivoting with blocks of one and two rows. A pivot of zero counts as just
    below: the shift itself is not above the shift.
    """
    a = matrix - shift * np.eye(len(matrix))
    above, k, n = 0, 0, len(a)
    while k < n:
        column = np.abs(a[k + 1 :, k])
        largest = column.max() if len(column) else 0.0
        pivot = a[k, k]
        if max(abs(pivot), largest) == 0.0:
            k += 1
            continue
        row, size = k, 1
        if abs(pivot) < _ALPHA * largest:
            row = k + 1 + int(column.argmax())
            others = np.abs(a[row, k:])
            others[row - k] = 0.0
            widest = others.max()
            if abs(pivot) * widest >= _ALPHA * largest**2:
                row = k
            elif abs(a[row, row]) < _ALPHA * widest:
                size = 2
        at = k + size - 1
        if row != at:
            a[[at, row], k:] = a[[row, at], k:]
            a[k:, [at, row]] = a[k:, [row, at]]
        rest = a[k + size :, k : k + size]
        if size == 1:
            above += a[k, k] > 0
            a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0], rest[:, 0] / a[k, k])
        else:
            # A block of two rows stands for one eigenvalue on either side.
            above += 1
            block = a[k : k + 2, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        k += size
    return int(above)


def isolate(matrix: np.ndarray, wanted: int, width: float) -> list[tuple[float, float, int, int]]:
    """Intervals ``(low, high, above, held)`` from the top that hold the ``wanted`` largest.

    ``above`` eigenvalues lie above ``high``, ``held`` in ``(low, high]``: one, or several
    where the interval is narrower than ``width``.
    """
    radius = float(np.abs(matrix).sum(axis=1).max()) * (1 + 8 * _EPS)
    open_, done = [(-radius - width, radius + width, 0, len(matrix))], []
    while open_:
        low, high, above, held = open_.pop()
        if above >= wanted or not held:
            continue
        middle = (low + high) / 2
        if held == 1 or high - low <= width or not low < middle < high:
            done.append((low, high, above, held))
            continue
        upper = min(max(count_above(matrix, middle) - above, 0), held)
        open_.append((low, middle, above + upper, held - upper))
        open_.append((middle, high, above, upper))
    return done


def _orthogonal(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    for _ in range(2):  # once more for what rounding left
        vector = vector - others.T @ (others @ vector)
    return vector / np.linalg.norm(vector)


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray, scale: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        return np.linalg.solve(shifted, vector)
    except np.linalg.LinAlgError:
        return np.linalg.solve(shifted + scale * _EPS * np.eye(len(matrix)), vector)


def _pair(
    matrix: np.ndarray, low: float, high: float, above: int, others: np.ndarray, start: np.ndarray, scale: float
) -> tuple[float, np.ndarray]:
    """The eigenpair whose value lies in ``(low, high]``, with ``above`` values above.

    Steps that leave the interval or gain nothing are answered with a count that halves
    it: in the end its middle is nearer to this eigenvalue than to any other.
    """
    width, exact = 64 * _EPS * scale, 64 * _EPS * scale * len(matrix) ** 0.5
    vector, shift, least, best = _orthogonal(start, others), (low + high) / 2, np.inf, None
    for _ in range(400):
        moved = _solve(matrix, shift, vector, scale)
        vector = _orthogonal(moved / np.abs(moved).max(), others)
        image = matrix @ vector
        value = float(vector @ image)
        error = float(np.linalg.norm(image - value * vector))
        if low - 8 * width <= value <= high + 8 * width and error < least / 2:
            least, best, shift = error, (value, vector), value
            continue
        if least <= exact and certified(matrix, best[0], 16 * width, above):
            return best
        if high - low > width:
            middle = (low + high) / 2
            low, high = (middle, high) if count_above(matrix, middle) > above else (low, middle)
        shift, least = (low + high) / 2, np.inf
    raise ArithmeticError(f"no eigenvalue numbered {above + 1} found between {low} and {high}")


def certified(matrix: np.ndarray, value: float, margin: float, above: int) -> bool:
    """Whether the counts just above and below a value leave the eigenvalue numbered ``above`` + 1 there."""
    return count_above(matrix, value + margin) <= above < count_above(matrix, value - margin)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order and their unit vectors as rows.

    Each value is certified by counts, up to rounding and to its cluster.
    """
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    wanted = min(wanted, size)
    scale = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
    if scale == 0.0:
        return np.zeros(wanted), np.eye(size)[:wanted]
    width = 64 * _EPS * scale
    starts = np.random.default_rng(size).normal(size=(size, size))
    values, vectors = [], np.zeros((0, size))
    for low, high, above, held in isolate(matrix, wanted, width):
        for member in range(min(held, wanted - above)):
            # In a cluster every value within it will do, but not the same vector twice.
            near = vectors[np.abs(np.array(values) - (low + high) / 2) <= 1e-3 * scale + high - low] if values else vectors
            value, vector = _pair(matrix, low, high, above, near, starts[above + member], scale)
            values.append(value)
            vectors = np.vstack([vectors, vector])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[order]
