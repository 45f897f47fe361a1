"""Whitening of embeddings: components by QDWH spectral divide-and-conquer, one broadcast projection.

An entry c becomes the integer floor(256 * c). The fit list holds each distinct vector of
integers once. Its sums are exact; its covariance, over the list's n and centred before
multiplying, is added up from one matrix a task. That matrix has dims * dims doubles,
whatever the number of rows, and is split on the driver:

    QDWH      the polar factor U of A - shift I, by inverse-free dynamically weighted
              Halley steps, each one QR of [sqrt(c) X; I]
    divide    (U + I) / 2 projects on the space of the eigenvalues above the shift; a basis
              of it, and one of the rest, make A block diagonal
    conquer   the shift is the mean eigenvalue, so each part is smaller; a part whose
              eigenvalues are equal up to rounding is not split further, any basis of it is
              as good

The upper part is taken first, the lower one only as far as components are wanted. Tasks
then get the mean and the scaled components (dims * (components + 1) doubles) and project
every row. Nothing else is broadcast.

Rows whose vector is null, or holds null or non-finite entries, are left out. Of vectors of
several lengths the shorter ones count as filled up with zeros; an empty vector is all
zeros. Entries beyond 64 bits after the scaling take the nearest 64-bit value. Components
without variance (an eigenvalue not above rounding) can't be scaled to one and are left
out, so equal vectors, a single vector and an empty table give no rows. Equal
eigenvalues: any basis of their space. Repeated rows are each returned, with equal values.
`deviation` beyond 64 bits is null; `deviation_text` has its digits always. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

COMPONENTS = 4
SCALE = 256
EPS = float(np.finfo(np.float64).eps)
#: Rows of a task's block of vectors.
BLOCK_ROWS = 4096
_LONG = (1 << 63) - 1


def polar(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by QDWH. A zero matrix gives zero."""
    m = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return np.zeros_like(a)
    # The Frobenius norm bounds the largest singular value; a lower bound that is too small costs a step or two.
    x, low, eye = a / size, max(EPS, 1 / size / max(np.linalg.norm(_inverse(a), 1), 1e-300) / np.sqrt(m)), np.eye(m)
    low = min(low, 1.0)
    for _ in range(steps):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(c) * x, eye)))
        after = b / c * x + (h - b / c) / np.sqrt(c) * (q[:m] @ q[m:].T)
        after = (after + after.T) / 2
        moved, x = np.linalg.norm(after - x), after
        low = min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        if moved <= np.cbrt(EPS) * 0.1 * np.sqrt(m) and 1 - low < 10 * EPS:
            return x
    return x


def _inverse(a: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.inv(a)
    except np.linalg.LinAlgError:
        return np.full_like(a, 1e300)


def _basis(projector: np.ndarray, rank: int, draw: np.random.Generator) -> np.ndarray:
    """Orthonormal columns of the projector's range."""
    q, _ = np.linalg.qr(projector @ draw.standard_normal((len(projector), rank)))
    q, _ = np.linalg.qr(projector @ q)
    return q


def _split(a: np.ndarray, floor: float, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the spaces of the larger and the smaller eigenvalues; None if all are equal up to `floor`."""
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m))
    if m == 1 or spread <= floor:
        return None
    # The mean lies between the extremes. Where an eigenvalue is on it, a shift beside it serves.
    for part in (0.0, 0.05, -0.05, 0.13, -0.13, 0.21, -0.21):
        projector = (polar(a - (mean + part * spread / np.sqrt(m)) * np.eye(m)) + np.eye(m)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < m or np.linalg.norm(projector @ projector - projector) > 1e-10 * m:
            continue
        upper, lower = _basis(projector, rank, draw), _basis(np.eye(m) - projector, m - rank, draw)
        if np.linalg.norm(lower.T @ a @ upper) <= 1e3 * m * EPS * np.linalg.norm(a):
            return upper, lower
    return None


def principal(cov: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling, of the largest `components` eigenvalues above rounding."""
    d = len(cov)
    floor = 4 * EPS * np.linalg.norm(cov)
    draw = np.random.default_rng(5)
    found: list[np.ndarray] = []
    parts = [np.eye(d)] if d else []
    have = 0
    while parts and have < components:
        basis = parts.pop()
        a = basis.T @ cov @ basis
        halves = _split((a + a.T) / 2, floor, draw)
        if halves is None:
            found.append(basis)
            have += basis.shape[1]
        else:
            parts += [basis @ halves[1], basis @ halves[0]]
    vectors = np.hstack(found) if found else np.zeros((d, 0))
    values = np.einsum("ij,ij->j", vectors, cov @ vectors)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > 4 * d * EPS * values.max(initial=0.0)]
    return values[order], vectors[:, order]


def _vectors(batches: Iterator[pa.RecordBatch], dims: int, column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows with their integers, shorter vectors filled up with zeros."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            lists = part.column(column)
            flat, size = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            if len(flat) == part.num_rows * dims and np.all(size == dims):
                yield part, flat.reshape(part.num_rows, dims)
            else:
                out = np.zeros((part.num_rows, dims), np.int64)
                out[np.arange(dims) < size[:, None]] = flat
                yield part, out


def exact_sums(x: np.ndarray) -> list[int]:
    """The sum of each column as exact integers, in two halves of 32 bits."""
    high, low = x >> 32, x & 0xFFFFFFFF
    return [(int(a) << 32) + int(b) for a, b in zip(high.sum(axis=0), low.sum(axis=0))]


def _summed(dims: int):
    """For mapInArrow: (dim, n, total as text) of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for part, x in _vectors(batches, dims):
            n += part.num_rows
            total = [a + b for a, b in zip(total, exact_sums(x))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, n)), pa.array([str(t) for t in total])], names=["dim", "n", "total"])

    return run


def _centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S / n: the whole part exactly, then its rest."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    if np.abs(x).max(initial=0) < 1 << 62 and np.abs(whole).max(initial=0) < 1 << 62:
        return (x - whole) - rest
    return (x.astype(object) - whole.astype(object)).astype(np.float64) - rest


def _products(dims: int, sums: list[int], n: int, project: np.ndarray | None):
    """For mapInArrow: (i, row of doubles, mean of its value) of a task's part of the covariance of the centred vectors, projected first if asked."""
    width = dims if project is None else project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first, any_ = np.zeros((width, width)), np.zeros(width), False
        for _, x in _vectors(batches, dims):
            y = _centred(x, sums, n)
            y = y if project is None else y @ project
            total, first, any_ = total + y.T @ y / n, first + y.sum(axis=0) / n, True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64())), pa.array(first)], names=["i", "products", "first"])

    return run


def _matrix(fitted: DataFrame, dims: int, sums: list[int], n: int, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance over the fit list: parts of each task added up row by row by Spark, width * width numbers on the driver."""
    parts = fitted.mapInArrow(_products(dims, sums, n, project), "i int, products array<double>, first double")
    each = parts.select("i", "first", F.posexplode("products").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"), F.sum("first").alias("first"))
    width = dims if project is None else project.shape[1]
    out, first, rows = np.zeros((width, width)), np.zeros(width), each.toArrow()
    i, j = rows.column("i").to_numpy(), rows.column("j").to_numpy()
    out[i, j], first[i] = rows.column("value").to_numpy(), rows.column("first").to_numpy()
    out = out - np.outer(first, first)
    return (out + out.T) / 2


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int]:
    """The sum over dimensions of (n * x - S) ** 2 of each row, exact."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * most * most < 1 << 63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = x.astype(object) * n - np.array(sums, object)
    return (apart * apart).sum(axis=1).tolist()


@dataclass(frozen=True)
class Whitening:
    """The fitted components: sums and size of the fit list, eigenvalues, unit vectors as columns, trace of the covariance."""

    dims: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of each entry as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Whether the vector is there and has only finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From rows (x) of integers: each distinct vector counts once. None without rows."""
    widest = vectors.agg(F.max(F.size("x"))).first()[0]
    if not widest:
        return None
    filled = F.when(F.size("x") < widest, F.concat("x", F.array_repeat(F.lit(0).cast("long"), (F.lit(widest) - F.size("x")).cast("int")))).otherwise(F.col("x"))
    fitted = stored(vectors.select(filled.alias("x")).distinct(), "fit-list")
    total = fitted.mapInArrow(_summed(widest), "dim int, n long, total string")
    total = total.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).orderBy("dim").collect()
    n, sums = total[0]["n"], [int(r["total"]) for r in total]
    cov = _matrix(fitted, widest, sums, n)
    values, found = principal(cov, components)
    error = 0.0
    if len(values):
        error = float(np.abs(_matrix(fitted, widest, sums, n, found / np.sqrt(values)) - np.eye(len(values))).max())
    return Whitening(widest, n, sums, values, found, float(np.trace(cov)), error)


def _whitened(model: Whitening):
    """For mapInArrow over (vec_id, x)."""
    k = len(model.values)
    project, explained = model.vectors / np.sqrt(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _vectors(batches, model.dims):
            out = _centred(x, model.sums, model.n) @ project
            rows = len(out)
            apart = deviations(x, model.sums, model.n)
            fits = pa.array([a if a <= _LONG else None for a in apart], pa.int64())
            each = pa.array(np.repeat(np.arange(rows), k))
            columns = {
                "vec_id": part.column("vec_id").take(each),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                "n": pa.array(np.full(rows * k, model.n, np.int64)),
                "deviation": fits.take(each),
                "whitened": pa.array(out.reshape(-1)),
                "explained": pa.array(np.tile(explained, rows)),
                "identity_error": pa.array(np.full(rows * k, model.identity_error)),
                "deviation_text": pa.array([str(a) for a in apart]).take(each),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text of every usable row and component."""
    rows = embeddings.filter(usable(F.col("embedding"))).select("vec_id", integers(F.col("embedding")).alias("x"))
    shape = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_text string"
    model = fit(rows.select("x"), components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], shape)
    return rows.mapInArrow(_whitened(model), shape)
