"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Entries become whole numbers x = floor(scale * c) + offset, so counts, sums and the scatter are exact.
The scatter is gathered in two passes: the sums first, then products of x minus the whole number next to
its mean; what that rounding leaves over is taken out in exact integers, so the covariance is rounded
once. Its Cholesky factor with pivoting, V = P L L' P', ends at the rank of V. One-sided Jacobi rotates
the columns of L until they are orthogonal: V = (P U)(P U)' with U = L J, so the squared norms of U's
columns are the eigenvalues of V and the normalised columns are its components. Small eigenvalues keep
their relative accuracy, which forming or squaring V further would cost them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: codes beyond this are no whole numbers of a double any more
LARGEST_CODE = float(1 << 53)
EXACT = 1 << 53


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: ``n`` rows, per-dimension ``sums``, all positive eigenvalues in falling
    order, the components as rows, the covariance's ``trace`` and the measured ``identity_error``."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def usable(vector: Column, width: int | None = None) -> Column:
    """Rows that take part: a vector that is not null and holds neither null, nor non-finite entries,
    nor any whose code would not fit; with ``width``, of that many entries."""
    entry_ok = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < LARGEST_CODE))
    ok = vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(entry_ok, F.lit(False))
    return ok if width is None else ok & (F.size(vector) == width)


def codes(vector: Column) -> Column:
    """Entries as whole numbers; null for those that do not fit, since Spark may compute codes before it filters."""
    def code(c: Column) -> Column:
        scaled = c.cast("double") * SCALE
        return F.when(F.abs(scaled) < LARGEST_CODE, F.floor(scaled).cast("long") + F.lit(OFFSET).cast("long"))

    return F.transform(vector, code)


def coded(rows: DataFrame) -> DataFrame:
    """vec_id, x for the rows that take part: those of the greatest length among the usable vectors
    (the entries that shorter ones lack count as null)."""
    rows = rows.select("vec_id", "embedding").filter(usable(F.col("embedding")))
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    return rows.filter(F.size("embedding") == width).select("vec_id", codes(F.col("embedding")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def _product_sums(x: np.ndarray) -> np.ndarray:
    """Exact x'x as Python integers."""
    largest = int(np.abs(x).max(initial=0))
    if largest >= 1 << 24:  # products that doubles cannot add up exactly
        wide = x.astype(object)
        return wide.T @ wide
    step = max(1, EXACT // max(1, largest * largest))
    total = np.zeros((x.shape[1],) * 2, object)
    for lo in range(0, len(x), step):
        part = x[lo:lo + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _added(rows: DataFrame, run, value: str) -> dict[tuple[int, int], object]:
    """Entries (i, j) of per-task matrices, added up by Spark: at most width squared numbers come back."""
    parts = rows.mapInArrow(run, f"i int, j int, v {value}")
    return {(r.i, r.j): r.v for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def scatter(rows: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """n^2 times the covariance of x, exactly; centred before multiplying."""
    width = len(sums)
    middle = [(2 * s + n) // (2 * n) for s in sums]  # the whole number next to the mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total += _product_sums(_matrix(batch.column(0), width) - np.array(middle, np.int64))
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(v) for v in total[i, j]], pa.decimal128(38, 0))], ["i", "j", "v"])

    products = _added(rows.select("x"), run, "decimal(38,0)")
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    full = [[0] * width for _ in range(width)]
    for (i, j), v in products.items():
        full[i][j] = full[j][i] = n * int(v) - rest[i] * rest[j]
    return full


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L): matrix[order][:, order] = L L' with falling diagonal; L has as many columns as the
    matrix has rank (a pivot under the rounding of the largest one ends it)."""
    work = np.array(matrix, np.longdouble)
    width = len(work)
    order = np.arange(width)
    factor = np.zeros((width, width), np.longdouble)
    floor = np.finfo(np.longdouble).eps * width * max(work.diagonal().max(initial=0), 0) * 4
    for k in range(width):
        p = k + int(np.argmax(work.diagonal()[k:]))
        if work[p, p] <= floor:
            return order, factor[:, :k]
        for a in (work, factor):
            a[[k, p]] = a[[p, k]]
        work[:, [k, p]] = work[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(work[k, k])
        factor[k + 1:, k] = work[k + 1:, k] / factor[k, k]
        work[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return order, factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor`` rotated until every two are orthogonal. Each round of a sweep rotates
    disjoint pairs of columns at once, and the rounds of a sweep meet every pair."""
    u = factor.T.copy()  # rows are the columns
    count = len(u)
    if count < 2:
        return u.T
    even = count + count % 2
    ring = np.arange(even)
    small = np.finfo(u.dtype).eps * np.sqrt(u.shape[1]) * 2
    for _ in range(sweeps):
        turned = False
        for _ in range(even - 1):
            p, q = ring[:even // 2], ring[::-1][:even // 2]
            real = (p < count) & (q < count)
            p, q = np.minimum(p, q)[real], np.maximum(p, q)[real]
            a, b, c = (u[p] ** 2).sum(1), (u[q] ** 2).sum(1), (u[p] * u[q]).sum(1)
            turn = np.abs(c) > small * np.sqrt(a * b)
            if turn.any():
                turned = True
                p, q, a, b, c = p[turn], q[turn], a[turn], b[turn], c[turn]
                zeta = (b - a) / (2 * c)
                t = np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
                cos = 1 / np.sqrt(1 + t * t)
                sin = cos * t
                x, y = u[p], u[q]
                u[p], u[q] = cos[:, None] * x - sin[:, None] * y, sin[:, None] * x + cos[:, None] * y
            ring = np.concatenate((ring[:1], np.roll(ring[1:], 1)))
        if not turned:
            break
    return u.T


def decompose(full: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, components as rows, trace) of the covariance full / n^2. The entry of
    greatest size of a component is positive (the first one of equals)."""
    width = len(full)
    square = n * n
    matrix = np.zeros((width, width), np.longdouble)
    for i in range(width):
        for j in range(width):
            whole, rest = divmod(full[i][j], square)
            matrix[i, j] = np.longdouble(whole) + np.longdouble(rest) / np.longdouble(square)
    order, factor = pivoted_cholesky(matrix)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated * rotated).sum(0))
    falling = np.argsort(-norms, kind="stable")
    components = np.zeros((len(falling), width), np.longdouble)
    components[:, order] = (rotated[:, falling] / norms[falling]).T
    for row in components:
        if row[int(np.argmax(np.abs(row)))] < 0:
            row *= -1
    trace = sum(full[i][i] for i in range(width)) / square if width else 0.0
    return (norms[falling] ** 2).astype(np.float64), components.astype(np.float64), float(trace)


def _project(x: np.ndarray, fitted: Whitening, count: int) -> np.ndarray:
    """x - S/n on the first components, over the root of their eigenvalues. x - S/n is one rounding of
    the exact quotient: the whole part and the fraction of the mean are taken off one after the other."""
    whole = np.array([s // fitted.n for s in fitted.sums], np.int64)
    part = np.array([(s % fitted.n) / fitted.n for s in fitted.sums])
    return ((x - whole).astype(np.float64) - part) @ (fitted.components[:count] / np.sqrt(fitted.eigenvalues[:count])[:, None]).T


def _identity_error(rows: DataFrame, fitted: Whitening, count: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on all rows."""
    width = len(fitted.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, count + 1))
        for batch in batches:
            w = _project(_matrix(batch.column(0), width), fitted, count)
            total[:, :count] += w.T @ w
            total[:, count] += w.sum(0)
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    held = _added(rows.select("x"), run, "double")
    total = np.array([[held[i, j] for j in range(count + 1)] for i in range(count)]) / fitted.n
    mean = total[:, count]
    return float(np.abs(total[:, :count] - np.outer(mean, mean) - np.eye(count)).max(initial=0.0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted on all rows of ``coded``; None where no row takes part. Per-task sums and matrices are
    added up by Spark; the driver holds matrices of width squared and nothing that grows with the rows."""
    found = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    sums = sorted((r.i, int(r.s), r.n) for r in found.collect())  # one row a dimension
    if not sums:
        return None
    n = sums[0][2]
    totals = [s for _, s, _ in sums]
    values, vectors, trace = decompose(scatter(rows, n, totals), n)
    fitted = Whitening(n, totals, values, vectors, trace)
    count = min(components, len(values))
    return Whitening(n, totals, values, vectors, trace, _identity_error(rows, fitted, count)) if count else fitted


def whitened(rows: DataFrame, fitted: Whitening, components: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation (exact sum over dimensions of (n*x - S)^2) and whitened (one double per component)."""
    width, count = len(fitted.sums), min(components, len(fitted.eigenvalues))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(fitted.sums, object)
        narrow = max(map(abs, fitted.sums), default=0) < 1 << 62
        for batch in batches:
            x = _matrix(batch.column(1), width)
            largest = int(np.abs(x).max(initial=0))
            away = None
            if narrow and largest * fitted.n < 1 << 62:
                away = x * np.int64(fitted.n) - sums.astype(np.int64)
                if int(np.abs(away).max(initial=0)) ** 2 * width >= 1 << 63:
                    away = away.astype(object)
            else:
                away = x.astype(object) * fitted.n - sums
            w = _project(x, fitted, count)
            offsets = np.arange(0, (len(x) + 1) * count, count, dtype=np.int32) if count else np.zeros(len(x) + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(v) for v in (away * away).sum(1)], pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """Whitened rows (see ``whitened``) of all vectors of ``embeddings`` (vec_id, embedding), with the fit.

    Dropped are vectors that are null, empty or hold null or non-finite entries, entries whose code does
    not fit 53 bits, and those shorter than the longest one left. Repeated rows, and rows with null or
    repeated vec_id, each count and each give a row. There are as many components as the covariance has
    rank, so fewer than ``components`` for few rows or dependent dimensions and none when all vectors
    are equal (``whitened`` is empty then). Components of equal eigenvalues may be any basis of their space.
    A table without rows gives none and no fit. Only ``vec_id`` and ``embedding`` are read, so other
    columns may have any names; all three passes read the table and shuffle matrix entries only."""
    rows = coded(embeddings)
    fitted = fit(rows, components)
    if fitted is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"), None
    return whitened(rows, fitted, components), fitted
