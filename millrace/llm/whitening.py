"""Whitening of embeddings.

Every partition computes the count, the mean and the centred scatter of its vectors, batch by batch; two of these merge by
Chan's formula, ``scatter = a + b + d d' n_a n_b / n`` with ``d`` the difference of the means, in a tree of tasks. The driver
decomposes the covariance, one matrix of dimension by dimension. A second pass over the vectors measures the covariance of
what the whitening gives, which should be the identity.

Vectors are taken as whole numbers, ``floor(scale * entry) + offset``. Sums of them are exact; scatters are of the numbers
less ``offset``, so that nothing is lost to a large common term.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Entries whose whole number is larger than this are no longer told apart by a double.
LARGEST = 1 << 53
#: Vectors that are turned into numbers at a time.
BATCH_ROWS = 2048
#: Partials that a task of the tree merges at most, about.
FAN_IN = 16
#: A component whose eigenvalue is smaller than this share of the largest is rounding.
LEAST_SHARE = 1e-12


@dataclass
class Moments:
    """Of vectors: how many, their exact sums if they are whole numbers, their mean and their centred scatter."""

    n: int
    sums: np.ndarray | None  # whole numbers without bound
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, y: np.ndarray) -> Moments:
        """Of a batch, a row a vector: 64-bit whole numbers or doubles."""
        if y.dtype == np.int64:
            narrow = len(y) * float(np.abs(y).max(initial=0)) < 2.0**62
            sums = y.sum(0).astype(object) if narrow else y.astype(object).sum(0)
            mean = sums.astype(float) / len(y)
        else:
            sums, mean = None, y.mean(0)
        centred = y - mean
        return cls(len(y), sums, mean, centred.T @ centred)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if self.sums is None:
            sums, gap = None, other.mean - self.mean
            mean = self.mean + gap * (other.n / n)
        else:  # the difference of the means is taken before anything is rounded
            sums = self.sums + other.sums
            gap = (self.n * other.sums - other.n * self.sums).astype(float) / (self.n * other.n)
            mean = sums.astype(float) / n
        return Moments(n, sums, mean, self.scatter + other.scatter + np.outer(gap, gap) * (self.n * other.n / n))

    @property
    def covariance(self) -> np.ndarray:
        return self.scatter / self.n


def whole_numbers(column: pa.Array, scale: float, offset: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Which vectors are usable, and by length the places of usable ones and their numbers less ``offset``, a row a vector.

    A null vector, an empty one, and one with an entry that is null, not finite or too large are not usable.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(invalid="ignore", over="ignore"):
        flat = np.floor(scale * flat)
        bad = ~(np.abs(flat) <= LARGEST - abs(offset))
    usable = lengths > 0
    usable[np.repeat(np.arange(len(lengths)), lengths)[bad]] = False
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    out = []
    for size in np.unique(lengths[usable]).tolist():
        at = np.flatnonzero(usable & (lengths == size))
        out.append((at, flat[first[at][:, None] + np.arange(size)].astype(np.int64)))
    return usable, out


def _in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _add(held: dict[int, Moments], size: int, more: Moments) -> None:
    held[size] = held[size].merged(more) if size in held else more


def _merged(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
    for size, more in b.items():
        _add(a, size, more)
    return a


def tree_moments(vectors: DataFrame, prepare) -> dict[int, Moments]:
    """Moments by vector length. ``prepare`` gives the arrays of vectors of a batch; a partition is one partial of the tree.

    A partial is a few matrices of dimension by dimension, however many vectors its partition has; no vectors, no moments.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in _in_batches(batches):
            for y in prepare(batch.column(0)):
                _add(held, y.shape[1], Moments.of(y))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held)], pa.binary())], names=["partial"])

    partials = vectors.mapInArrow(partial, "partial binary").rdd.map(lambda row: pickle.loads(row[0]))
    count = partials.getNumPartitions()
    if not count:
        return {}
    return partials.treeReduce(_merged, depth=max(1, math.ceil(math.log(count, FAN_IN))))


@dataclass
class Whitening:
    """``sums``: exact, of the whole numbers less ``offset``. ``components``: unit eigenvectors, a column each."""

    scale: float
    offset: int
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]

    def gaps(self, y: np.ndarray) -> np.ndarray:
        """``n * x - sum`` of each entry, exact: 64-bit numbers where they suffice, else Python's."""
        narrow = self.n * float(np.abs(y).max(initial=0)) + max(map(abs, self.sums.tolist()), default=0) < 2.0**62
        return self.n * y - self.sums.astype(np.int64) if narrow else self.n * y.astype(object) - self.sums

    def whitened(self, gaps: np.ndarray) -> np.ndarray:
        return (gaps / self.n).astype(float) @ self.components / np.sqrt(self.eigenvalues)

    @staticmethod
    def deviations(gaps: np.ndarray) -> np.ndarray:
        """Sums of squares, exact."""
        if gaps.dtype == np.int64 and float(np.abs(gaps).max(initial=0)) ** 2 * gaps.shape[1] < 2.0**62:
            return (gaps * gaps).sum(1).astype(object)
        wide = gaps.astype(object)
        return (wide * wide).sum(1)


def fit_whitening(
    vectors: DataFrame, vector_col: str = "embedding", components: int = 32, scale: float = 64, offset: int = 1_000_000
) -> Whitening | None:
    """The whitening of all usable vectors: up to ``components`` of them, numbered by falling eigenvalue.

    Vectors that are null or empty or hold an entry that is null, not finite or beyond 2**53 are left out. If lengths differ, the
    most frequent one is taken, the longest of ties, and vectors of other lengths are left out too. A direction in which
    the vectors do not differ has no component. None without usable vectors. Repeated rows count as often as they occur. The
    sign of a component is that which makes its largest entry positive.
    """

    def prepare(column):
        return [y for _, y in whole_numbers(column, scale, offset)[1]]

    found = tree_moments(vectors.select(vector_col), prepare)
    if not found:
        return None
    size = max(found, key=lambda s: (found[s].n, s))
    m = found[size]
    e, u = np.linalg.eigh((m.covariance + m.covariance.T) / 2)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > max(e.max(), 0) * LEAST_SHARE]
    u = u[:, order]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    return Whitening(scale, offset, m.n, m.sums, u, e[order], float(np.trace(m.covariance)))


def whiten(vectors: DataFrame, model: Whitening | None, vector_col: str = "embedding") -> DataFrame:
    """The rows with usable vectors of the model's length, with ``whitened`` (array of double) and ``deviation`` (decimal(38,0)).

    ``deviation`` is the sum of squares of ``n * x - sum`` over all dimensions, exact, null from 10**38. Columns of these two
    names are replaced. Without a model there are no rows.
    """
    rest = vectors.drop("whitened", "deviation")
    schema = T.StructType(list(rest.schema.fields)).add("whitened", T.ArrayType(T.DoubleType())).add("deviation", T.DecimalType(38, 0))
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    sent = vectors.sparkSession.sparkContext.broadcast(model)  # dimension by components, whatever the number of vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        k = len(model.eigenvalues)
        for batch in _in_batches(batches):
            column = batch.column(batch.schema.get_field_index(vector_col))
            for at, y in whole_numbers(column, model.scale, model.offset)[1]:
                if y.shape[1] != model.dim:
                    continue
                gaps = model.gaps(y)
                values = pa.array(model.whitened(gaps).reshape(-1))
                white = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()), values)
                far = model.deviations(gaps).tolist()
                if max(far) < 1 << 62:
                    far = pa.array(far, pa.int64()).cast(pa.decimal128(38, 0))
                else:
                    far = pa.array([str(x) if x < 10**38 else None for x in far], pa.string()).cast(pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, white, far], names=[*batch.schema.names, "whitened", "deviation"])

    return rest.mapInArrow(run, schema)


def identity_error(whitened: DataFrame, column: str = "whitened") -> float:
    """The largest entry, without sign, of the covariance of whitened vectors less the identity; 0 without any."""

    def prepare(array):
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        return [array.flatten().to_numpy().reshape(len(array), -1)] if len(array) and len(array.flatten()) else []

    found = tree_moments(whitened.select(column), prepare)
    if not found:
        return 0.0
    (m,) = found.values()
    return float(np.abs(m.covariance - np.eye(len(m.mean))).max())
