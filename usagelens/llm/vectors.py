"""Vectors as whole numbers, and exact sums of products of them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST, MOST = -(1 << 63), (1 << 63) - 1
# Up to here doubles are exact whole numbers, and so are sums that stay below.
EXACT = float(1 << 53)


def usable(vector: Column) -> Column:
    """Neither NULL nor with a component that is NULL or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & finite


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, which are exact for a scale that is a power of two.

    What leaves the range of doubles becomes the largest of them.
    """
    with np.errstate(over="ignore"):
        made = np.floor(values * float(scale))
    most = np.finfo(np.float64).max
    return np.clip(made, -most, most)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for every length of the lists of doubles in ``column``."""
    lengths = np.asarray(column.value_lengths())
    values = column.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[first[rows, None] + np.arange(length)]


def lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    n, length = matrix.shape
    offsets = np.arange(n + 1, dtype=np.int32) * length
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def largest(matrix: np.ndarray) -> float:
    return float(np.abs(matrix).max()) if matrix.size else 0.0


def as_long(value) -> int:
    """The nearest number that a long can hold."""
    return max(LEAST, min(MOST, int(value)))


def big(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers, which have no limit."""
    made = np.empty(matrix.shape, object)
    made.ravel()[:] = [int(x) for x in matrix.ravel().tolist()]
    return made


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact: as doubles, or as Python integers
    where doubles do not suffice."""
    if a.shape[1] * largest(a) * largest(b) < EXACT:
        return a @ b.T
    return big(a).dot(big(b).T)


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """Which rows have components so small that distances between such rows are exact doubles."""
    if not matrix.size:
        return np.ones(len(matrix), bool)
    most = np.sqrt(EXACT / matrix.shape[1]) / 2 - 1
    return np.array(np.abs(matrix).max(axis=1) < most, bool)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a.dot(b.T) + (b * b).sum(1)[None, :]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point, ties to the lower one, and the squared distance.

    Exact for whole numbers of any size; distances are doubles, or Python integers if need be.
    """
    small, few = _narrow(points), _narrow(entries)
    if small.all() and few.all():
        found = _distances(points, entries.astype(np.float64))
        index = found.argmin(axis=1)
        return index, found[np.arange(len(points)), index]
    index, best = np.zeros(len(points), np.int64), np.empty(len(points), object)
    plain = np.flatnonzero(few)
    if small.any() and len(plain):
        at, found = nearest(points[small], entries[plain])
        index[small], best[small] = plain[at], found
    for rows, own in ((small, np.flatnonzero(~few)), (~small, np.arange(len(entries)))):
        if not rows.any() or not len(own):
            continue
        found = _distances(big(points[rows]), big(entries[own]))
        for place, row in enumerate(np.flatnonzero(rows)):
            i = min(range(len(own)), key=lambda k: (found[place, k], k))
            if best[row] is None or (found[place, i], own[i]) < (best[row], index[row]):
                index[row], best[row] = own[i], found[place, i]
    return index, best
