"""Whitening of embeddings by the leading components of their covariance, found by contour integration (FEAST).

Entries become whole numbers ``floor(scale * entry)``. Spark adds them and their centred products up exactly: tasks sum
their own rows in numpy (centred at the rounded mean, whose remainder is corrected in whole numbers), and only d x d sums
move. So the covariance does not depend on how rows are dealt out, and does not cancel where the mean is far from zero. The
driver holds that matrix, whose size is that of a vector squared and does not grow with the table.

Its eigenvalues are counted by inertia: the tridiagonal form shifted by s has as many negative pivots as eigenvalues lie
below s. Counts choose intervals of up to ``WIDTH`` eigenvalues that end in the widest gaps. For each interval, a quadrature
over a circle through its ends adds up solutions of complex shifted systems, which projects random vectors onto the
interval's components; Rayleigh-Ritz extracts them, and the round is repeated until as many as the counts say are exact.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.llm.tables import map_rows

COMPONENTS = 32
WIDTH = 8
NODES = 16
# Components below this share of the largest eigenvalue are rounding noise and cannot be whitened.
LEAST = 1e-11
# Whole numbers up to this are exact as doubles; entries up to the second one fit a long with room for an offset.
EXACT = 2.0**53
LARGEST = 2.0**62


def usable(df: DataFrame, vector: str, scale: float) -> DataFrame:
    """Rows whose vector is not null and holds no null, no NaN, and nothing too large for a long when scaled."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | ~(F.abs(x.cast("double") * scale) < LARGEST))
    return df.filter(F.col(vector).isNotNull() & ~bad)


def _matrices(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches whose last column holds vectors of one length, with the scaled entries, whole numbers as doubles."""
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield batch, np.floor(flat * scale).reshape(batch.num_rows, -1)


def _whole(values: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers, without a bound."""
    return np.frompyfunc(int, 1, 1)(values)


def _exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of whole numbers without rounding."""
    most = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1)
    total = _whole(np.zeros((a.shape[1], b.shape[1])))
    if most >= EXACT:
        return total + _whole(a).T @ _whole(b)
    step = int(EXACT / most)
    for at in range(0, len(a), step):
        total = total + _whole(a[at : at + step].T @ b[at : at + step])
    return total


def _added(parts: DataFrame, add: Callable[[list], object]) -> dict[int, list]:
    """Rows ``(i, values)`` of all tasks added up per ``i`` and place; numbers travel as text and stay exact."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: defaultdict[int, list] = defaultdict(list)
        for i, values in rows:
            held[i].append([int(v) if "." not in v and "e" not in v else float(v) for v in values])
            if len(held[i]) == 64:
                held[i] = [[add(list(column)) for column in zip(*held[i])]]
        for i, lists in held.items():
            yield i, [repr(add(list(column))) for column in zip(*lists)]

    total = map_rows(parts.repartition("i"), run, "i int, values array<string>")
    return {r.i: [int(v) if "." not in v and "e" not in v else float(v) for v in r["values"]] for r in total.collect()}


def _task_sums(df: DataFrame, one: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, list]]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, values in one(batches):
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([[repr(v) for v in values]], pa.list_(pa.string()))], names=["i", "values"])

    return df.mapInArrow(run, "i int, values array<string>")


@dataclass(frozen=True)
class Covariance:
    """``n`` rows, the sums of their scaled entries, the rounded means, and the matrix."""

    n: int
    sums: list[int]
    matrix: np.ndarray


def covariance(rows: DataFrame, scale: float) -> Covariance:
    """Sums and covariance (divisor n) of the one column of ``rows``, vectors of one length."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
        n, total = 0, None
        for batch, u in _matrices(batches, scale):
            n += batch.num_rows
            part = _exact_products(np.ones((len(u), 1)), u)[0]
            total = part if total is None else total + part
        if total is not None:
            yield 0, [n, *total.tolist()]

    found = _added(_task_sums(rows, sums), sum)
    if not found:
        return Covariance(0, [], np.zeros((0, 0)))
    n, *total = found[0]
    middle = [(2 * s + n) // (2 * n) for s in total]
    centre = np.array(middle, float)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
        whole = None
        for _, u in _matrices(batches, scale):
            y = u - centre if np.abs(u).max(initial=0) + np.abs(centre).max(initial=0) < EXACT else _whole(u) - np.array(middle, object)
            part = _exact_products(y, y)
            whole = part if whole is None else whole + part
        for i, row in enumerate([] if whole is None else whole.tolist()):
            yield i, row

    found = _added(_task_sums(rows, products), sum)
    about = np.array([found[i] for i in range(len(total))], object).reshape(len(total), len(total))
    rest = np.array([s - n * m for s, m in zip(total, middle)], object)
    return Covariance(n, total, ((about * n - np.outer(rest, rest)) / (n * n)).astype(float))


def _tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the same eigenvalues (Householder)."""
    a = v.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        x[0] += math.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size > 0:
            x /= size
            a[k + 1 :, :] -= 2 * np.outer(x, x @ a[k + 1 :, :])
            a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1) ** 2


def _count_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues below each shift: negative pivots of the shifted tridiagonal matrix."""
    tiny = np.finfo(float).tiny * 1e20
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(int)
    for a, b in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = a - shifts - b / pivot
        count += pivot < 0
    return count


def _intervals(diagonal: np.ndarray, off: np.ndarray, most: int) -> list[tuple[float, float, int]]:
    """``(low, high, eigenvalues inside)``, from the largest down, with all of the ``most`` largest that are not noise."""
    d = len(diagonal)
    bound = 1 + 1e-9
    low, high = np.full(d, -bound), np.full(d, bound)
    for _ in range(60):
        middle = (low + high) / 2
        above = d - _count_below(diagonal, off, middle) > np.arange(d)
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    value = (low + high) / 2
    wanted = min(most, int((value > LEAST * value[0]).sum()))
    ends = np.concatenate((value, [2 * value[-1] - value[0] - 1e-3]))
    gap = ends[:-1] - ends[1:]
    out, top, edge = [], 0, value[0] + max(value[0] - value[-1], 1e-3) / d
    while top < wanted:
        cut = range(top + WIDTH // 2, min(top + WIDTH, d) + 1)
        last = wanted if top + WIDTH >= wanted else max((k for k in cut), key=lambda k: gap[k - 1])
        while last < d and gap[last - 1] < 1e-9 * value[0]:
            last += 1
        below = (ends[last - 1] + ends[last]) / 2
        inside = np.diff(_count_below(diagonal, off, np.array([below, edge])))[0]
        out.append((below, edge, int(inside)))
        top, edge = last, below
    return out


def _feast(v: np.ndarray, low: float, high: float, inside: int, rng: np.random.Generator) -> np.ndarray:
    """The components of ``v`` whose eigenvalues lie between ``low`` and ``high``, ``inside`` of them."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    angle = np.pi * (nodes + 1) / 2
    size = min(d, inside + max(4, inside // 2))
    y = rng.standard_normal((d, size))
    for round_ in range(1, 200):
        projected = np.zeros_like(y)
        for a, w in zip(angle, weights):
            turn = radius * np.exp(1j * a)
            projected += w / 2 * np.real(turn * np.linalg.solve((centre + turn) * np.eye(d) - v, y.astype(complex)))
        q = np.linalg.qr(projected)[0]
        value, small = np.linalg.eigh(q.T @ v @ q)
        x = q @ small
        exact = np.linalg.norm(v @ x - x * value, axis=0) < 5e-15 * math.sqrt(d)
        kept = exact & (value > low) & (value < high)
        if kept.sum() == inside:
            return x[:, kept]
        if round_ % 10 == 0 and size < d:
            # slow or not enough room: look in a larger space, in the end in all of it
            size = min(d, 2 * size)
            x = np.concatenate([x, rng.standard_normal((d, size - x.shape[1]))], axis=1)
        y = x
    raise ArithmeticError(f"components between {low} and {high} were not found")


def leading_components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns, largest entry positive) of a covariance matrix.

    At most ``most``, and only those above ``LEAST`` of the largest; none for a matrix of zeros.
    """
    scale = float(np.abs(matrix).sum(1).max(initial=0))
    if scale == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    v = (matrix + matrix.T) / (2 * scale)
    rng = np.random.default_rng(7)
    found = [_feast(v, *interval, rng) for interval in _intervals(*_tridiagonal(v), most)]
    # the intervals' components together once more, so that they are orthogonal to the last digit
    q = np.linalg.qr(np.concatenate(found, axis=1))[0]
    value, small = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-value)[:most]
    value, x = value[order], (q @ small)[:, order]
    real = value > LEAST * value[0]
    x = x[:, real]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(x.shape[1])])
    return value[real] * scale, x


def common_length(df: DataFrame, vector: str) -> int | None:
    """The most frequent length of the vectors; of equally frequent ones the longest."""
    sizes = df.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return top[0].d if top else None


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0, most: int = COMPONENTS) -> DataFrame:
    """One row ``(key, component, n, deviation, whitened, explained, identity_error)`` per vector and component.

    ``deviation`` is the squared distance of the scaled entries from their means, times n squared, exact (null where it does
    not fit a long); ``explained`` the component's share of the variance; ``identity_error`` how far the covariance of
    ``whitened`` is from the identity at most.

    Vectors that are null or hold null, NaN, infinite entries, or entries of 2^62 / scale and more, take no part, nor do
    those whose length is not the common one. Rows that repeat an id or a vector count as rows of their own; a null id stays
    null. Components without variance cannot be whitened and are left out, so a table of one vector, or of equal vectors,
    gives no rows, like an empty one. Other columns are ignored.
    """
    name, kind = key, df.schema[key].dataType.simpleString()
    rows = usable(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector", scale)
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    length = common_length(rows, "vector")
    fit = covariance(rows.filter(F.size("vector") == length).select("vector"), scale) if length else Covariance(0, [], np.zeros((0, 0)))
    value, axes = leading_components(fit.matrix, most)
    if not len(value):
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", name)
    rows = rows.filter(F.size("vector") == length)
    n, sums, turn = fit.n, fit.sums, axes / np.sqrt(value)
    largest = max(map(abs, sums))

    def centred(u: np.ndarray) -> np.ndarray:
        """n times the distance from the mean, in whole numbers."""
        if n * np.abs(u).max(initial=0) + largest < EXACT:
            return (u * n - np.array(sums, float)).astype(np.int64)
        return _whole(u) * n - np.array(sums, object)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
        count, first, second = 0, np.zeros(len(value)), np.zeros((len(value), len(value)))
        for batch, u in _matrices(batches, scale):
            w = (centred(u) / n).astype(float) @ turn
            count, first, second = count + batch.num_rows, first + w.sum(0), second + w.T @ w
        for i, row in enumerate([[*first.tolist()], *second.tolist()] if count else []):
            yield i, row

    found = _added(_task_sums(rows.select("vector"), moments), math.fsum)
    mean = np.array(found[0]) / n
    second = np.array([found[i + 1] for i in range(len(value))]) / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(value))).max())
    # the exact trace of the matrix that was decomposed
    explained = value / math.fsum(np.diag(fit.matrix))

    def squares(z: np.ndarray) -> list[int | None]:
        if z.dtype != object and len(sums) * float(np.abs(z).max(initial=0)) ** 2 < LARGEST:
            return (z * z).sum(1).tolist()
        return [s if s < 2**63 else None for s in (sum(int(x) ** 2 for x in row) for row in z.tolist())]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(value)
        for batch, u in _matrices(batches, scale):
            z = centred(u)
            w = (z / n).astype(float) @ turn
            at = pa.array(np.repeat(np.arange(len(u)), k))
            columns = [
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(u))), pa.array(np.full(len(u) * k, n, np.int64)),
                pa.array(squares(z), pa.int64()).take(at), pa.array(w.ravel()), pa.array(np.tile(explained, len(u))), pa.array(np.full(len(u) * k, error)),
            ]
            yield pa.record_batch(columns, names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema).withColumnRenamed("key", name)
