"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it: every pass over the vectors multiplies a narrow block
Q by the centred XᵀX, one task after another on its own rows, and only blocks of Q's shape are added up. A few Lanczos passes bound
the spectrum from below; the smallest Ritz value of the block bounds the wanted part. Between these the Chebyshev
recurrence damps the unwanted spectrum, ``degree`` passes a cycle, then QR and Rayleigh-Ritz follow. The block has ``guard`` columns
more than are wanted.

Certified means: the residual of every wanted pair is at most ``tolerance`` of the largest eigenvalue, and stays so, with the same
eigenvalues, through one more cycle in which fresh random directions took the places of half of the guard columns; an eigenvector
that the first block had missed would enter there. Without that after ``cycles`` cycles it raises an error.

Entries become whole numbers first, floor(scale c) + shift, so that counts, sums and deviations are exact; covariances are centred
before multiplying. The vectors are stored once as blocks of numbers, which all passes read. A pass that loses an executor repeats
the tasks it lost. What the driver holds is a few blocks of Q's shape, whatever the number of vectors.

Defined cases: a vector that is null, holds null or non-finite entries, or has not the commonest length takes no part and has no
rows. Entries whose whole number is beyond 2^62 take the nearest of that size; a deviation beyond a long is the largest long.
Components without variance (under 1e-10 of the largest eigenvalue) cannot be whitened and are left out, so equal vectors, a
single one or none give no rows; fewer dimensions than components give fewer components. Equal eigenvalues: any orthonormal basis
of their space, the same for all rows. Repeated rows and ids count and are returned once each, a null id as null. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.llm.vectors import chunks, dimension, finite, folded, whole_numbers
from transferlens.session import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
GUARD = 16
DEGREE = 10
LANCZOS = 12
CYCLES = 200
TOLERANCE = 1e-13
#: Largest product that int64 holds.
_LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Spectrum:
    """The fit: number of vectors, exact sums, trace, and the leading eigenvalues with their unit vectors as columns."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def blocks_of(df: DataFrame, size: int, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(ids, x): blocks of vectors as whole numbers, row by row."""
    own = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows, values = finite(part.column(1), size)
            x = whole_numbers(values, scale) + shift
            ids = part.column(0).take(pa.array(rows))
            for own in chunks(len(rows), size):
                block = pa.ListArray.from_arrays(pa.array([0, own.stop - own.start], pa.int32()), ids[own])
                yield pa.RecordBatch.from_arrays([block, pa.array([x[own].tobytes()], pa.binary())], ["ids", "x"])

    return own.mapInArrow(cut, f"ids array<{own.schema['id'].dataType.simpleString()}>, x binary")


def _numbers(batches: Iterator[pa.RecordBatch], size: int, column: int) -> Iterator[np.ndarray]:
    for part in batches:
        for value in part.column(column):
            yield np.frombuffer(value.as_py(), np.int64).reshape(-1, size)


def _exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the columns as whole numbers without bound."""
    most = max(-int(x.min()), int(x.max()), 1)
    return x.sum(axis=0).astype(object) if most * len(x) <= _LARGEST else x.astype(object).sum(axis=0)


def _totals(blocks: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums. Sums travel as two halves of 40 bits and the rest, so that adding them stays exact."""

    def each(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        n, sums = 0, np.zeros(size, dtype=object)
        for x in _numbers(batches, size, 0):
            n, sums = n + len(x), sums + _exact_sums(x)
        low = [int(s) & ((1 << 40) - 1) for s in sums]
        high = [int(s) >> 40 for s in sums]
        return np.array([n, *low, *high], dtype=np.int64) if n else None

    found = folded(blocks.select("x"), each, np.add, "int64")
    if found is None:
        return 0, [0] * size
    numbers = found.tolist()
    return numbers[0], [low + (high << 40) for low, high in zip(numbers[1 : size + 1], numbers[size + 1 :], strict=True)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Sum over the dimensions of (n x - S)^2, exact."""
    reach = max((abs(n * int(end) - s) for end_of in (x.min(axis=0), x.max(axis=0)) for end, s in zip(end_of, sums, strict=True)), default=0)
    small = max(map(abs, sums), default=0) <= _LARGEST and n * max(-int(x.min()), int(x.max()), 1) <= _LARGEST
    if small and reach * reach * x.shape[1] <= _LARGEST:
        away = n * x - np.array(sums, dtype=np.int64)
        return (away * away).sum(axis=1)
    away = n * x.astype(object) - np.array(sums, dtype=object)
    return np.array([min(int(v), _LARGEST) for v in (away * away).sum(axis=1)], dtype=np.int64)


class _Operator:
    """The covariance as a product with narrow blocks, one pass over the stored vectors each."""

    def __init__(self, blocks: DataFrame, size: int, n: int, mean: np.ndarray) -> None:
        self.blocks, self.size, self.n, self.mean, self.passes = blocks.select("x"), size, n, mean, 0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        size, mean = self.size, self.mean
        self.passes += 1

        def each(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros_like(q)
            for x in _numbers(batches, size, 0):
                centred = x - mean
                out += centred.T @ (centred @ q)
            return out.ravel()

        return folded(self.blocks, each, np.add).reshape(q.shape) / self.n

    def trace(self) -> float:
        size, mean = self.size, self.mean

        def each(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            return np.array([sum(float(np.square(x - mean).sum()) for x in _numbers(batches, size, 0))])

        return float(folded(self.blocks, each, np.add)[0]) / self.n


def lower_bound(product: Callable[[np.ndarray], np.ndarray], size: int, steps: int, rng: np.random.Generator) -> float:
    """A bound below the spectrum: the least Ritz value of a Lanczos run less its last residual; a covariance has none below 0."""
    basis, diagonal, beside = [], [], []
    v = rng.standard_normal(size)
    v /= np.linalg.norm(v)
    for _ in range(min(steps, size)):
        basis.append(v)
        w = product(v[:, None])[:, 0]
        diagonal.append(float(v @ w))
        for _ in range(2):  # full orthogonalisation, twice
            w -= np.array(basis).T @ (np.array(basis) @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * max(diagonal):
            break
        v = w / beside[-1]
    inner = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(inner)[0]) - beside[-1])


def chebyshev(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, aq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of the covariance times q: small on [low, high], one at ``top``. ``aq`` is its first product."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    y = (aq - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        q, y = y, (product(y) - middle * y) * (2 * after / half) - (sigma * after) * q
        sigma = after
    return y


def rayleigh_ritz(product: Callable[[np.ndarray], np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by falling size, their vectors, and the products of these."""
    q, _ = np.linalg.qr(y)
    aq = product(q)
    inner = q.T @ aq
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values[::-1], q @ turn[:, ::-1], aq @ turn[:, ::-1]


def spectrum(
    blocks: DataFrame, size: int, *, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE,
    tolerance: float = TOLERANCE, cycles: int = CYCLES, seed: int = 11,
) -> Spectrum | None:
    """The certified leading part of the covariance of stored ``blocks``; None without vectors."""
    n, sums = _totals(blocks, size)
    if not n or not size:
        return None
    rng = np.random.default_rng(seed)
    product = _Operator(blocks, size, n, np.array([s / n for s in sums]))
    trace = product.trace()
    wanted, width = min(components, size), min(components + guard, size)
    values, q, aq = rayleigh_ritz(product, rng.standard_normal((size, width)) if width < size else np.eye(size))
    if width < size and trace > 0:
        low = lower_bound(product, size, LANCZOS, rng)
        proved = None  # the wanted values before the fresh directions came in
        for _ in range(cycles):
            worst = np.linalg.norm(aq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
            held = worst <= tolerance * values[0]
            if held and proved is not None and np.allclose(values[:wanted], proved, rtol=1e-10, atol=1e-12 * values[0]):
                break
            proved = values[:wanted].copy() if held else None
            if held:
                fresh = guard // 2 or 1
                q = np.concatenate([q[:, : width - fresh], rng.standard_normal((size, fresh))], axis=1)
                values, q, aq = rayleigh_ritz(product, q)
            high = max(float(values[-1]), 1e-6 * float(values[0]))  # a block wider than the rank has Ritz values of about 0
            if values[0] - high <= 1e-12 * values[0]:  # the block is all of one eigenvalue: nothing to damp
                values, q, aq = rayleigh_ritz(product, aq)
                continue
            y = chebyshev(product, q, aq, min(low, 0.99 * high), high, float(values[0]), degree)
            values, q, aq = rayleigh_ritz(product, y)
        else:
            raise RuntimeError(f"the leading {wanted} components are not certified after {cycles} cycles")
    keep = [k for k in range(wanted) if values[k] > 1e-10 * max(values[0], 0) and values[k] > 0]
    return Spectrum(n, sums, trace, values[keep], q[:, keep], product.passes)


def _identity_error(blocks: DataFrame, size: int, mean: np.ndarray, onto: np.ndarray, n: int) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, from the vectors themselves."""
    width = onto.shape[1]

    def each(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((width, width))
        for x in _numbers(batches, size, 0):
            white = (x - mean) @ onto
            out += white.T @ white
        return out.ravel()

    return float(np.abs(folded(blocks.select("x"), each, np.add).reshape(width, width) / n - np.eye(width)).max())


def whitened(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT, **settings) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = df.select(vec_id).schema[0].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not (size := dimension(df, vector)):
        return df.sparkSession.createDataFrame([], schema)
    blocks = stored(blocks_of(df, size, vec_id=vec_id, vector=vector, scale=scale, shift=shift), "whitening-blocks")
    fit = spectrum(blocks, size, **settings)
    if fit is None or not len(fit.values):
        return df.sparkSession.createDataFrame([], schema)
    n, sums, mean = fit.n, fit.sums, fit.mean
    onto, explained = fit.vectors / np.sqrt(fit.values), fit.values / fit.trace
    error, width = _identity_error(blocks, size, mean, onto, n), len(fit.values)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for ids, x in zip(part.column(0), _numbers([part], size, 1), strict=True):
                count = len(x) * width
                each_row = pa.array(np.repeat(np.arange(len(x)), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each_row),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(count, n)),
                        pa.array(np.repeat(deviations(x, n, sums), width)),
                        pa.array(((x - mean) @ onto).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(count, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return blocks.mapInArrow(rows, schema)
